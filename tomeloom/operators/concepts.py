"""One concept for each chunk, by a model or by a rule."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, EngineConfig
from ..functions.text import strip
from ..schemas import CHUNK_JSON, IDEA_JSON, SPLIT_JSON
from ..session import stored
from .calls import ask_once, replies, request_key
from .chunking import chunks_greedy_merge

#: Own prompts. What a model is asked for one paragraph:
IDEA_PROMPT = """You read one paragraph of a technical book and name the one term that it is about.
- One term only: the one to which most of the paragraph (60 to 90 percent of it) goes. A term that is only mentioned does not count.
- The usual English term, even if the paragraph is in another language, and its short form where that is the common one (an acronym rather than its expansion).
- Nothing that the text does not say. No sentence, no explanation.
- Leave aside what only leads from one topic to the next, tables of contents, running examples, citations and references.
- If no term is left, the answer is the empty string.
Answer with JSON: {"concept": "..."}"""
#: for a section that is to be cut into paragraphs:
SPLIT_PROMPT = """You cut a section of a technical book into paragraphs of one idea each.
- Begin a new one where the topic, the definition or the argument changes, and where a long example sets in. Keep an idea and its explanation together.
- A paragraph has 200 to 800 characters as a rule, never under 100 and hardly ever over 1200.
- Copy the text exactly, white space included. Leave nothing out and repeat nothing: the paragraphs in a row are the section.
- start_marker is the first 30 to 50 characters of the paragraph, exactly as they stand.
Answer with JSON: {"paragraphs": [{"text": "...", "start_marker": "..."}]}"""
#: and for a large piece of text, both in one call:
SPLIT_AND_NAME_PROMPT = SPLIT_PROMPT.rsplit("\n", 1)[0] + """
- For each paragraph, concept is the one English term that most of it is about, "" if there is none.
- section_title is the heading under which the paragraph stands, null if the text shows none.
Answer with JSON: {"paragraphs": [{"text": "...", "concept": "...", "section_title": "..."}]}"""


class ChatModel(Protocol):
    """Made once in each worker by a factory; gets a prompt and a text and returns JSON."""

    def __call__(self, prompt: str, text: str) -> str: ...


class Prompted:
    """A chat model with its prompt, as a function of the text. The client is made where it is first called, so this can be sent to workers."""

    def __init__(self, factory: Callable[[], ChatModel], prompt: str):
        self.factory, self.prompt, self.chat = factory, prompt, None

    def __getstate__(self):
        return {"factory": self.factory, "prompt": self.prompt, "chat": None}

    def __call__(self, text: str) -> str:
        if self.chat is None:
            self.chat = self.factory()
        return self.chat(self.prompt, text)


class ConceptModel(Protocol):
    """Made once in each worker by a factory; gets a chunk and returns JSON."""

    def __call__(self, text: str) -> str: ...


def rule_concept(text: Column) -> Column:
    """A stand-in for a model: the first capitalised ASCII word, or an empty concept."""
    return F.regexp_extract(text, "([A-Z][a-z]+)", 1)


def concept_extract(chunks: DataFrame, factory: Callable[[], ConceptModel] | None = None, text: str = "paragraph", config: EngineConfig = DEFAULT, answers: str | None = None) -> DataFrame:
    """chunks with concept (null for chunks of under min_concept_text characters) and error (what the model raised or mis-said).

    Short chunks never reach the model. With answers, a path, what was answered before is taken from there and new answers go there; without, store the result before using it twice.
    """
    long = F.length(strip(F.col(text))) >= config.min_concept_text
    if factory is None:
        return chunks.withColumn("concept", F.when(long, rule_concept(F.col(text)))).withColumn("error", F.lit(None).cast("string"))
    asked = chunks.withColumn("ask", F.when(long, F.col(text)))
    said = ask_once(asked, "ask", IDEA_PROMPT, factory, answers, config) if answers else replies(asked, "ask", factory, config)
    concept = F.from_json("reply", IDEA_JSON)["concept"]
    bad = F.col("reply").isNotNull() & concept.isNull()
    return said.drop("ask").withColumn("concept", concept).withColumn("error", F.when(bad, "no concept in the reply").otherwise(F.col("error"))).drop("reply")


def split_and_name(rows: DataFrame, factory: Callable[[], ChatModel], text: str = "content", config: EngineConfig = DEFAULT) -> DataFrame:
    """rows without text, with paragraph_index, paragraph, concept, section_title and error: large chunks (big_chunk characters), each cut and named in one call.

    A chunk whose reply can't be read is one paragraph without a concept, and error says so. Paragraphs without a section title take the one before in
    the row; rows that are equal in all other columns are rows of their own. The model is called once for each chunk; store the result before using it twice.
    """
    others, rows = [c for c in rows.columns if c != text], rows.withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, "rows-to-name")  # so that a row keeps its number
    asked = chunks_greedy_merge(rows, text, config.updated(merge_max=config.big_chunk)).drop("para_start", "para_end").withColumnRenamed("paragraph_index", "chunk_index")
    found = replies(asked, "chunk", lambda: Prompted(factory, SPLIT_AND_NAME_PROMPT), config)
    said = F.filter(F.from_json("reply", CHUNK_JSON)["paragraphs"], lambda p: F.length(p.text) > 0)
    whole = F.array(F.struct(F.col("chunk").alias("text"), F.lit(None).cast("string").alias("concept"), F.lit(None).cast("string").alias("section_title")))
    read = F.coalesce(F.size(said) > 0, F.lit(False))
    found = found.withColumn("error", F.when(~read, F.coalesce("error", F.lit("no paragraphs in the reply"))))
    each = found.select(*others, "row", "chunk_index", "error", F.posexplode(F.when(read, said).otherwise(whole)).alias("part", "p"))
    in_row = Window.partitionBy("row").orderBy("chunk_index", "part")
    title = F.last(F.when(F.lower("p.section_title") != "null", F.col("p.section_title")), ignorenulls=True).over(in_row.rowsBetween(Window.unboundedPreceding, 0))
    return each.select(*others, (F.row_number().over(in_row) - 1).alias("paragraph_index"), F.col("p.text").alias("paragraph"), F.col("p.concept").alias("concept"), title.alias("section_title"), "error")


def parse_replies(rows: DataFrame, reply: str = "reply") -> DataFrame:
    """rows with what each reply holds: concept, n_paragraphs and n_pairs; null where it can't be read."""
    split, pairs = F.from_json(reply, SPLIT_JSON)["paragraphs"], F.from_json(reply, CHUNK_JSON)["paragraphs"]
    return rows.withColumns({"concept": F.from_json(reply, IDEA_JSON)["concept"], "n_paragraphs": F.when(split.isNotNull(), F.size(split)), "n_pairs": F.when(pairs.isNotNull(), F.size(F.filter(pairs, lambda p: p.concept.isNotNull())))})


def not_answered(chunks: DataFrame, answers: DataFrame, text: str = "paragraph", config: EngineConfig = DEFAULT) -> DataFrame:
    """chunks whose request_key is not among answers (request_key): what a run that goes on has still to ask."""
    return chunks.withColumn("request_key", request_key(F.col(text), IDEA_PROMPT, config)).join(answers.select("request_key").distinct(), "request_key", "left_anti").select(*chunks.columns)
