"""Calls of models: at once, in order, at a rate, once for each request."""

import json
import time
from concurrent.futures import ThreadPoolExecutor

from tomeloom.config import DEFAULT
from tomeloom.operators import calls, chunking, concepts

QUICK = DEFAULT.updated(retry_delays=(0,), retry_attempts=1)


def test_calls_overlap_and_keep_their_order(spark):
    df = spark.createDataFrame([(i, None if i % 10 == 0 else f"t{i}") for i in range(64)], "i int, t string").coalesce(1)

    def sleeps():
        def answer(text):
            time.sleep(0.1 + (hash(text) % 3) * 0.01)
            if text == "t7":
                raise RuntimeError("down")
            return text.upper()

        return answer

    def timed(config):
        began = time.perf_counter()
        rows = [tuple(r) for r in calls.replies(df, "t", sleeps, config).collect()]
        return rows, time.perf_counter() - began

    timed(QUICK)
    many, fast = timed(QUICK)
    one, slow = timed(QUICK.updated(model_calls=1))
    assert many == one == [(i, None, None, None) if i % 10 == 0 else (i, "t7", None, "RuntimeError: down") if i == 7 else (i, f"t{i}", f"T{i}", None) for i in range(64)]
    assert slow > 5 and fast < slow / 4


def test_rate_and_retries():
    now = [0.0]
    gate = calls.at_most(10, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))
    for _ in range(21):
        gate()
    assert abs(now[0] - 2.0) < 1e-9
    asked = []

    def fails_twice(text):
        asked.append(text)
        if len(asked) < 3:
            raise ValueError(text)
        return "ok"

    with ThreadPoolExecutor(1) as pool:
        config = DEFAULT.updated(retry_delays=(0,), retry_attempts=3)
        assert calls.in_order(fails_twice, ["a", None], config, pool, lambda: None) == [("ok", None), (None, None)] and asked == ["a"] * 3


def test_nothing_is_asked_twice(spark, tmp_path):
    log, answers = str(tmp_path / "log"), str(tmp_path / "answers")

    def model(bad):
        def factory():
            def answer(text):
                with open(log, "a") as f:
                    f.write(text[:3] + "\n")
                if text[:3] == bad:
                    raise RuntimeError("down")
                return json.dumps({"concept": text[:3]})

            return answer

        return factory

    rows = spark.createDataFrame([(i, f"t{i % 5:02d} " + "x" * 60) for i in range(40)] + [(50, "short"), (51, None)], "i int, paragraph string").repartition(4)
    get = lambda bad=None, df=rows: {r.i: (r.concept, r.error) for r in concepts.concept_extract(df, model(bad), config=QUICK, answers=answers).collect()}
    asked = lambda: open(log).read().split()
    first = get("t03")
    assert sorted(asked()) == ["t00", "t01", "t02", "t03", "t04"] and first[3] == (None, "RuntimeError: down") and first[50] == first[51] == (None, None)
    assert get()[3] == ("t03", None) and len(asked()) == 6
    assert all(c == (f"t{i % 5:02d}", None) for i, c in get().items() if i < 50) and len(asked()) == 6
    more = rows.union(spark.createDataFrame([(60, "new " + "x" * 60)], rows.schema))
    assert get(df=more)[60] == ("new", None) and len(asked()) == 7


def test_a_splitter_that_fails_leads_to_the_rule(spark):
    def down(text):
        raise RuntimeError("down")

    df = spark.createDataFrame([(1, ("word " * 30).strip() + "\n\n" + ("more " * 30).strip())], "id int, content string")
    assert [(r.method, r.paragraph_index) for r in chunking.split_paragraphs(df, down, config=QUICK).collect()] == [("rule", 0), ("rule", 1)]
