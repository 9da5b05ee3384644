"""Text functions on columns. Positions count code points from 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\x1C-\x1F]"
#: All white space of Unicode, and the four separators U+001C to U+001F.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: The mark of a cut text, the share kept from its front, and titles that open a book's front matter.
MARK = "\n\n[... truncated ...]\n\n"
FRONT_TENTHS = 8
FRONT_MATTER = ["cover", "copyright", "table of contents", "preface", "acknowledgments", "foreword", "introduction", "about the author", "about the", "dedication", "contents"]


def strip(c: Column) -> Column:
    """Without white space (all of Unicode's) at both ends."""
    return F.btrim(c, F.lit(SPACES))


def squeeze(c: Column) -> Column:
    """Each run of white space as one space, none at the ends."""
    return strip(F.regexp_replace(c, rf"(?U){SPACE}+", " "))


def collapse(c: Column) -> Column:
    """Three or more line feeds as two."""
    return F.regexp_replace(c, "\n{3,}", "\n\n")


def cut(c: Column, start: Column, end: Column) -> Column:
    """c[start:end]; empty if end <= start."""
    return F.substring(c, start.cast("int") + 1, F.greatest(end - start, F.lit(0)).cast("int"))


def truncate(c: Column, most: int = 10_000) -> Column:
    front = most * FRONT_TENTHS // 10
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, front), F.lit(MARK), F.right(c, F.lit(most - front)))).otherwise(c)


def dropped_chars(c: Column, most: int = 10_000) -> Column:
    """Characters that truncate() leaves out."""
    return F.greatest(F.length(c) - most, F.lit(0))


def _seek(text: Column, marker: Column) -> Column:
    """Exact place of marker, else its place among squeezed white space scaled back; null if neither."""
    runs = rf"(?U){SPACE}+"
    flat = F.regexp_replace(text, runs, " ")
    loose = F.call_function("locate", squeeze(marker), flat) - 1
    scaled = F.when(F.length(flat) > 0, F.floor(loose.cast("double") / F.length(flat) * F.length(text))).otherwise(0)
    exact = F.call_function("locate", marker, text) - 1
    return F.when(exact >= 0, exact).when(loose >= 0, scaled).cast("int")


def marker_position(text: Column, marker: Column, full_text: Column | None = None, search_from: Column | int = 0) -> Column:
    """Where marker stands in text from search_from on, else in full_text, else search_from; never below 0."""
    origin = F.lit(search_from) if isinstance(search_from, int) else search_from
    here = origin + _seek(cut(text, origin, F.length(text)), marker)
    there = F.when(full_text != text, _seek(full_text, marker)) if full_text is not None else F.lit(None)
    return F.when(F.coalesce(F.length(marker), F.lit(0)) == 0, origin).otherwise(F.coalesce(here, there, origin)).cast("int")


def preview(c: Column, most: int = 200) -> Column:
    return F.concat(F.replace(F.left(c, F.lit(most)), F.lit("\n"), F.lit(" ")), F.when(F.length(c) > most, "...").otherwise(""))


def clip(c: Column, most: int = 40) -> Column:
    return F.left(c, F.lit(most))


def hierarchy_path(*titles: Column) -> Column:
    """Titles that aren't empty, joined with ' > '."""
    return F.concat_ws(" > ", *[F.when(t != "", t) for t in titles])


def is_front_matter(title: Column) -> Column:
    return F.lower(strip(title)).rlike("^(" + "|".join(FRONT_MATTER) + ")")


def percentage(part: Column, total: Column) -> Column:
    return F.when(total > 0, part / total * 100).otherwise(F.lit(0.0)).cast("double")


def file_title(path: Column) -> Column:
    """A path's last part without .pdf."""
    return F.replace(F.element_at(F.split(path, "/"), -1), F.lit(".pdf"), F.lit(""))
