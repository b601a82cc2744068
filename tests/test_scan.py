import json
import uuid
import sys

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from notevalue.operators import enrich, scan
from notevalue.sources.cache import append_results, load_cache
from notevalue.sources import seen as seen_table
from notevalue.sources.seen import load_seen, remember, write_seen
from notevalue.streaming.enrich_stream import stream_enrich
from notevalue.streaming.plan_stream import LISTING_SCHEMA, stream_plan
from rows import NOTE

# The scorer below runs in workers, which cannot import this file.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

GOOD = {"fruit": 2, "oak": 1, "tannin": 0, "acidity": 3, "body": 2, "finish": 1, "age_worthy": True, "summary": "dense"}


def replies(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id bigint, reply string")


@pytest.mark.parametrize(
    ("change", "valid"),
    [
        ({}, True), ({"fruit": "2"}, True), ({"fruit": 2.0}, True), ({"fruit": 2.5}, False), ({"fruit": 9}, False), ({"fruit": -1}, False),
        ({"fruit": None}, False), ({"fruit": [1]}, False), ({"age_worthy": "no"}, True), ({"age_worthy": 1}, True), ({"age_worthy": "perhaps"}, False),
        ({"age_worthy": 2}, False), ({"summary": 5}, False), ({"extra": {"x": 1}}, True),
    ],
)
def test_replies_are_validated_field_by_field(spark, change, valid):
    good, bad = enrich.validate_replies(replies(spark, json.dumps({**GOOD, **change})))
    assert (good.count(), bad.count()) == ((1, 0) if valid else (0, 1))


def test_unreadable_and_incomplete_replies_are_invalid(spark):
    short = {key: value for key, value in GOOD.items() if key != "finish"}
    good, bad = enrich.validate_replies(replies(spark, "no idea", json.dumps(short), "[]", None))
    assert good.count() == 0 and bad.count() == 4


def test_the_cache_skips_bad_lines_and_keeps_the_last(spark, tmp_path):
    path = tmp_path / "cache"
    path.mkdir()
    lines = [{"id": 1, "tasting": {**GOOD, "summary": "old"}}, "broken", {"id": 2}, {"id": "3", "tasting": GOOD}, {"id": 4, "tasting": {}}, {"id": 1, "tasting": {**GOOD, "summary": "new"}}]
    (path / "part.txt").write_text("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines))
    rows = load_cache(spark, str(path)).collect()
    assert [(r["id"], r["tasting"]["summary"]) for r in rows] == [(1, "new")]


def test_a_repeated_run_leaves_no_second_copy(spark, tmp_path):
    path = str(tmp_path / "cache")
    first, _ = enrich.validate_replies(replies(spark, json.dumps(GOOD), json.dumps(GOOD)))
    append_results(first, path, 0)
    append_results(first, path, 1)
    append_results(first.filter("id = 0"), path, 1)
    assert spark.read.text(path).count() == 3 and load_cache(spark, path).count() == 2


def scorer(notes: pd.Series, attempt: int) -> pd.Series:
    """Answers notes starting with `a` at once, with `b` on the third try, others never."""
    ready = notes.str.startswith("a") | (notes.str.startswith("b") & (attempt >= 3))
    return ready.map({True: json.dumps({**GOOD, "summary": f"try {attempt}"}), False: "?"})


def test_scoring_retries_and_leaves_failures_pending(spark):
    rows = spark.createDataFrame([(0, "a0"), (1, "b1"), (2, "c2"), (3, "a3")], "id bigint, description string")
    done, failed = enrich.enrich(rows, scorer, attempts=3, workers=2)
    assert {r["id"]: r["tasting"]["summary"] for r in done.collect()} == {0: "try 1", 3: "try 1", 1: "try 3"}
    assert [r["id"] for r in failed.collect()] == [2]


def test_an_interrupted_pass_resumes_where_it_stopped(spark, tmp_path):
    path = str(tmp_path / "cache")
    rows = spark.createDataFrame([(i, f"a{i}") for i in range(20)], "id bigint, description string")
    done, _ = enrich.enrich(enrich.pending(rows, spark.createDataFrame([], "id bigint"), 7), scorer)
    append_results(done, path, 0)
    todo = enrich.pending(rows, load_cache(spark, path))
    assert sorted(r["id"] for r in todo.collect()) == list(range(7, 20))
    done, _ = enrich.enrich(todo, scorer)
    append_results(done, path, 1)
    assert spark.read.text(path).count() == 20 and enrich.pending(rows, load_cache(spark, path)).count() == 0


def test_attached_text_and_coverage(spark):
    cache, _ = enrich.validate_replies(replies(spark, json.dumps(GOOD)))
    rows = spark.createDataFrame([(0, "train", "old"), (1, "train", "kept"), (2, "test", None)], "id bigint, split string, summary string")
    got = {r["id"]: r["summary"] for r in enrich.attach(rows, cache).collect()}
    assert got == {0: "dense\nfruit=2 oak=1 tannin=0 acidity=3 body=2 finish=1 age_worthy=True", 1: "kept", 2: None}
    assert {r["split"]: (r["matched"], r["total"]) for r in enrich.coverage(rows, cache).collect()} == {"train": (1, 2), "test": (0, 1)}


def test_a_spent_budget_keeps_the_prefix(spark):
    rows = spark.createDataFrame([(0, "x" * 7), (1, "y" * 8), (2, "z" * 400), (3, "w")], "id bigint, description string")
    got = enrich.budget_prefix(rows, budget=25, max_tokens=10).orderBy("id").collect()
    assert [(r["id"], r["cost"], r["spent"]) for r in got] == [(0, 11, 11), (1, 12, 23)]
    assert enrich.budget_prefix(rows, budget=5, max_tokens=10).count() == 0


PAGE = (
    "<html><head><title>T &amp; U</title><style>p{}</style></head><body><header><nav>menu</nav>head</header>"
    "<form><input>form</form><p>One<b>two</b></p><!-- no --><script>if (a < b) { x = '</p>'; }</script><p>caf&eacute;&nbsp;x</p><footer>f</footer></body>"
)


def test_page_text_drops_what_is_not_prose(spark):
    rows = spark.createDataFrame([(PAGE,), (None,), ("",)], "html string")
    pattern = [r["body"] for r in scan.page_text(rows, method="pattern").collect()]
    parser = [r["body"] for r in scan.page_text(rows).collect()]
    assert parser == ["T & U One two café x", "", ""]
    assert pattern == ["T & U One two caf&eacute; x", "", ""]


def test_the_parser_follows_nesting(spark):
    rows = spark.createDataFrame([("<div>a<nav>x<div>y</div><nav>z</nav>w</nav>b<form>c</div>d",)], "html string")
    assert scan.page_text(rows).first()["body"] == "a b d"


def test_articles_are_capped_and_taken_newest_first(spark):
    rows = spark.createDataFrame([("f", i, "t", None, "x" * 24_000) for i in range(5)] + [("g", 0, "t", "s", "b")], "feed string, position int, title string, summary string, body string")
    texts = scan.article_text(scan.per_feed(rows, 2))
    assert texts.count() == 3 and {len(r["text"]) for r in texts.collect()} == {12_000, len("t\n\ns\n\nb")}


def wine(**changes):
    return {"name": "W", "note": NOTE, "price": 25.0, "url": "", **changes}


def test_listings_need_a_real_note_and_a_price(spark):
    answers = [
        [wine()], [wine(note="Nice.")], [wine(price=0)], [wine(), wine(note="Nice.")], [wine(price="30", url="u")], [wine(name=None)], [], [wine(url=None)],
        [{key: value for key, value in wine().items() if key != "url"}],
    ]
    rows = [(f"a{i}", json.dumps({"wines": found})) for i, found in enumerate(answers)] + [("a9", "nonsense"), ("a10", "{}")]
    good, bad = scan.listings(spark.createDataFrame(rows, "article_url string, reply string"))
    assert sorted((r["article_url"], r["url"], r["price"]) for r in good.collect()) == [("a0", "a0", 25.0), ("a4", "u", 30.0), ("a8", "a8", 25.0)]
    assert {r["article_url"] for r in bad.collect()} == {"a1", "a2", "a3", "a5", "a7", "a9", "a10"}


def found(spark, *rows):
    return spark.createDataFrame([(name, NOTE, float(price), "u") for name, price in rows], LISTING_SCHEMA)


def estimator(df):
    return df.withColumn("guess", F.lit(45.0))


def test_out_of_range_listings_are_dropped_and_counted(spark):
    rows = found(spark, ("fine", 61), ("pallet", 7_350), ("cork", 3.5), ("jar", 0.4))
    assert [r["name"] for r in scan.in_range(rows).collect()] == ["fine"]
    assert scan.range_summary(rows).first()[:] == (1, 3)


def test_discounts_rank_and_alert(spark):
    fresh = scan.unseen(found(spark, ("a", 30), ("b", 44.5), ("c", 60)), spark.createDataFrame([], "key string"))
    ranked = scan.opportunities(fresh, estimator)
    assert [(r["name"], r["discount"]) for r in ranked.collect()] == [("a", 15.0), ("b", 0.5), ("c", -15.0)]
    assert [r["summary"] for r in scan.alerts(ranked).collect()] == ["a: listed $30, we estimate $45 (gap $+15)\nu"]
    texts = {r["name"]: r["summary"] for r in scan.alerts(ranked, -100).collect()}
    assert texts["c"] == "c: listed $60, we estimate $45 (gap $-15)\nu" and texts["b"].startswith("b: listed $44, we estimate $45 (gap $+0)")


def test_a_second_run_reports_nothing(spark, tmp_path):
    seen, out = str(tmp_path / "seen"), str(tmp_path / "out")
    rows = found(spark, ("a", 30), ("b", 40), ("b", 41), ("lot", 9000))
    assert scan.plan(spark, rows, estimator, seen, out, 1).count() == 3
    assert scan.plan(spark, rows, estimator, seen, out, 1).count() == 3
    assert scan.plan(spark, rows, estimator, seen, out, 2).count() == 0
    assert sorted(r["key"] for r in load_seen(spark, seen).collect()) == ["u#a", "u#b"]


def test_keys_are_remembered_as_a_set(spark, tmp_path):
    key = lambda *names: spark.createDataFrame([(n,) for n in names], "key string")
    assert load_seen(spark, str(tmp_path / "none")).count() == 0
    write_seen(key("a", "b", "b"), str(tmp_path / "s"), 0)
    write_seen(key("c"), str(tmp_path / "s"), 1)
    assert load_seen(spark, str(tmp_path / "s"), before=1).count() == 2
    assert sorted(r["key"] for r in remember(load_seen(spark, str(tmp_path / "s")), key("c", "d")).collect()) == ["a", "b", "c", "d"]


def test_runs_are_folded_and_a_crash_between_changes_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(seen_table, "FOLD", 2)
    root = str(tmp_path / "s")
    key = lambda *names: spark.createDataFrame([(n,) for n in names], "key string").coalesce(1)
    keys_of = lambda **options: sorted(r["key"] for r in load_seen(spark, root, **options).collect())
    write_seen(key("a", "z"), root, 0)
    write_seen(key("b", "z"), root, 1)
    with monkeypatch.context() as lost:
        lost.setattr(seen_table, "_remove_folded", lambda *_: None)
        write_seen(key("c"), root, 2)
    # The folded segments are still there, and are not read.
    assert seen_table.complete_segments(spark, root) == [(0, 0), (0, 1), (0, 2), (1, 1)]
    assert seen_table.live_segments(spark, root) == [(0, 2), (1, 1)]
    assert keys_of() == ["a", "b", "c", "z"] and keys_of(before=1) == ["a", "z"] and keys_of(before=2) == ["a", "b", "z"]
    write_seen(key("c"), root, 2)
    assert seen_table.complete_segments(spark, root) == [(0, 2), (1, 1)]
    for run in (3, 4):
        write_seen(key(f"k{run}"), root, run)
    # Two of level 1 became one of level 2; without its mark it would not count, and the older ones would.
    assert seen_table.live_segments(spark, root) == [(0, 4), (2, 3)]
    assert keys_of() == ["a", "b", "c", "k3", "k4", "z"]
    with pytest.raises(ValueError, match="folded"):
        write_seen(key("late"), root, 3)
    some = seen_table.seen_keys(spark, root, among=key("b"))
    assert {"b", "k4"} <= {r["key"] for r in some.collect()} and "PartitionFilters: [bucket" in some._jdf.queryExecution().toString()
    (tmp_path / "s" / "level=2" / "upto=3" / "_SUCCESS").unlink()
    assert keys_of() == ["k4"]


def test_the_stream_reports_what_the_batch_reports_and_survives_a_crash(spark, tmp_path):
    source, seen, out, checkpoint = (str(tmp_path / name) for name in ("in", "seen", "out", "check"))
    found(spark, ("a", 30), ("b", 40)).coalesce(1).write.mode("append").json(source)
    stream = lambda: spark.readStream.schema(LISTING_SCHEMA).option("maxFilesPerTrigger", 1).json(source)
    failed = []

    def breaks_after_writing(df):
        if not failed:
            failed.append(1)
            scan.plan(spark, found(spark, ("a", 30), ("b", 40)), estimator, seen, out, 0)
            raise RuntimeError("lost")
        return estimator(df)

    with pytest.raises(Exception, match="lost"):
        stream_plan(stream(), breaks_after_writing, seen, out, checkpoint).awaitTermination()
    found(spark, ("b", 40), ("c", 50), ("lot", 9000)).coalesce(1).write.mode("append").json(source)
    stream_plan(stream(), breaks_after_writing, seen, out, checkpoint).awaitTermination()
    stream_plan(stream(), estimator, seen, out, checkpoint).awaitTermination()
    assert sorted(r["name"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_streamed_enrichment_matches_the_batch(spark, tmp_path):
    source, cache, checkpoint = (str(tmp_path / name) for name in ("in", "cache", "check"))
    rows = spark.createDataFrame([(i, f"{'abc'[i % 3]}{i}") for i in range(12)], "id bigint, description string")
    rows.filter("id < 8").coalesce(1).write.mode("append").parquet(source)
    rows.filter("id > 4").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    stream_enrich(stream, scorer, cache, checkpoint).awaitTermination()
    got = {r["id"]: r["tasting"]["summary"] for r in load_cache(spark, cache).collect()}
    done, _ = enrich.enrich(rows, scorer)
    assert got == {r["id"]: r["tasting"]["summary"] for r in done.collect()}
    assert spark.read.text(cache).count() == len(got)


def test_a_scorer_that_raises_leaves_its_rows_pending(spark):
    def scorer(notes, attempt):
        if notes.str.contains("spent").any():
            raise enrich.AllowanceSpent
        if notes.str.contains("broken").any():
            raise RuntimeError("no answer")
        return pd.Series(["not json"] * len(notes), index=notes.index)

    for word in ("broken", "spent"):
        rows = spark.createDataFrame([(i, word if i == 3 else "plain") for i in range(6)], "id bigint, description string")
        done, failed = enrich.enrich(rows, scorer, attempts=2)
        assert done.count() == 0 and sorted(r["id"] for r in failed.collect()) == list(range(6))


def test_answers_before_a_spent_allowance_are_kept(spark):
    def until_spent(notes, attempt):
        if notes.str.contains("spent").any():
            raise enrich.AllowanceSpent
        return scorer(notes, attempt)

    rows = spark.createDataFrame([(i, "spent" if i == 3 else f"a{i}") for i in range(6)], "id bigint, description string")
    done, left = enrich.enrich(rows.coalesce(1), until_spent)
    assert sorted(r["id"] for r in done.collect()) == [0, 1, 2] and sorted(r["id"] for r in left.collect()) == [3, 4, 5]


def test_an_allowance_holds_across_tasks_and_its_rest_returns(spark):
    rows = spark.createDataFrame([(i, f"{'abc'[i % 3]}{i:03}") for i in range(120)], "id bigint, description string")
    # A grant is 301 tokens, an answer uses far fewer: the first pass may ask 33 rows, later ones more.
    first, left, spent = enrich.enrich_within(rows, scorer, 10_000, passes=1, workers=50)
    assert sorted(r["id"] for r in first.collect()) == list(range(0, 33, 3)) and left.count() == 109 and spent <= 10_000
    done, left, spent = enrich.enrich_within(rows, scorer, 10_000, passes=3, workers=50)
    ids, rest = [r["id"] for r in done.collect()], [r["id"] for r in left.collect()]
    assert len(ids) > 11 and spent <= 10_000 and sorted(ids + rest) == list(range(120))


def test_an_allowance_of_nothing_asks_nobody(spark):
    rows = spark.createDataFrame([(1, "a1"), (2, None)], "id bigint, description string")
    done, left, spent = enrich.enrich_within(rows, scorer, 0)
    assert done.count() == 0 and left.count() == 2 and spent == 0
    assert enrich.enrich_within(rows.limit(0), scorer, 1_000)[2] == 0


def test_scorers_get_notes_in_bounded_batches(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(enrich, "BATCH_BYTES", 100)
    sizes = tmp_path / "sizes"
    sizes.mkdir()

    def scorer(notes, attempt):
        (sizes / uuid.uuid4().hex).write_text(f"{len(notes)} {notes.str.len().sum()}")
        return notes.map(lambda note: json.dumps(GOOD))

    rows = spark.createDataFrame([(i, "x" * (300 if i == 5 else 30)) for i in range(20)], "id bigint, description string").coalesce(1)
    batch = rows.toArrow().to_batches()[0]
    parts = list(enrich._parts(batch))
    assert sum(part.num_rows for part in parts) == 20 and max(part.num_rows for part in parts) == 3
    monkeypatch.undo()
    monkeypatch.setattr(enrich, "BATCH_ROWS", 4)
    assert [part.num_rows for part in enrich._parts(batch)] == [4] * 5
    done, left = enrich.enrich(rows, scorer)
    assert done.count() == 20 and left.count() == 0 and list(sizes.iterdir())


def test_the_streamed_plan_writes_its_listings_with_all_tasks(spark, small, monkeypatch):
    from notevalue.plans.scanning import t1_stream_plan

    def refuse(self, n):
        raise AssertionError("all listings in one task")

    monkeypatch.setattr(type(spark.range(1)), "coalesce", refuse)
    stored = t1_stream_plan(spark, small)
    assert stored.count() == stored.select("key").distinct().count() > 0
