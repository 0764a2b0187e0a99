import datetime as dt
import json
import time

import numpy as np
import pandas as pd
import pytest

from newsweave.operators import extraction as ex
from newsweave.operators.joins import pending
from newsweave.plans import extraction_queries, views
from newsweave.session import work_path
from newsweave.streaming import jobs

GAZETTEER = [("berlin", "locations"), ("green party", "political_parties"), ("ann", "people")]


def articles(spark, rows):
    return spark.createDataFrame(rows, "seq bigint, url string, text string")


def test_blank_texts_give_no_prompt(spark):
    df = articles(spark, [(1, "a", "x"), (2, "b", None), (3, "c", "  \n"), (4, "d", "")])
    assert [r["url"] for r in ex.with_prompts(df).collect()] == ["a"]
    prompt = ex.with_prompts(df).first()["prompt"]
    assert prompt.endswith("x") and all(word in prompt for word in ("political_parties", "partners with", "HOSTILE"))


def test_retry_only_for_rate_limits(monkeypatch):
    waits, calls = [], []
    monkeypatch.setattr(ex.time, "sleep", waits.append)

    def call(prompt):
        calls.append(prompt)
        if prompt == "limit" and calls.count("limit") == 1 or prompt == "always":
            raise RuntimeError("Quota exceeded")
        if prompt == "bad":
            raise RuntimeError("no such model")
        return f" {prompt} "

    batch = pd.DataFrame({"url": list("abcd"), "prompt": ["ok", "limit", "bad", "always"]})
    found = next(ex.call_each(call, pause=1, retry_wait=60)(iter([batch])))
    assert list(found["response_text"]) == ["ok", "limit", None, None]
    assert list(found["error"]) == [None, None, "no such model", "Quota exceeded"]
    assert waits == [1, 60, 1, 1, 60, 1] and calls.count("bad") == 1


def test_extract_runs_the_given_extractor(spark):
    df = articles(spark, [(i, f"u{i}", f"text {i}") for i in range(20)])
    found = ex.extract(df, ex.call_each(lambda p: '{"n": %d}' % len(p), pause=0), max_partitions=2).collect()
    assert len(found) == 20 and all(json.loads(r["response_text"])["n"] > 100 for r in found)


def test_failed_replies_appear_in_both_outputs(spark):
    rows = [(1, "a", "prose", None), (2, "b", '{"entities": {"p"', None), (3, "c", "{}", None), (4, "d", None, "429"), (5, "e", "", None)]
    df = spark.createDataFrame(rows, "seq bigint, url string, response_text string, error string")
    parsed = ex.parse_responses(df)
    assert sorted(r["url"] for r in ex.extraction_errors(parsed).collect()) == ["a", "b", "d"]
    assert [r["url"] for r in ex.extraction_errors(parsed).filter("rate_limited").collect()] == ["d"]
    assert ex.extraction_results(parsed).count() == 5
    assert sorted(r["url"] for r in ex.extraction_results(parsed, retry_failed=True).collect()) == ["c", "e"]
    assert {(r["extracted_entities"], r["entity_relationships"]) for r in parsed.collect()} == {("{}", "[]")}


def test_one_bad_element_does_not_void_the_list(spark):
    relations = [
        17,
        {"source": "a", "target": "b", "relationship": "leads", "sentiment": None},
        {"source": "a", "target": "b", "relationship": "leads"},
        {"source": "c", "target": "d", "relationship": "leads", "sentiment": "H", "extra": 1},
    ]
    entities = {"people": ["a", "b"], "places": "x", "none": []}
    df = spark.createDataFrame(
        [(1, "u", dt.date(2024, 1, 1), json.dumps(entities), json.dumps(relations))],
        "seq bigint, url string, date date, extracted_entities string, entity_relationships string",
    )
    nested = ex.parse_nested(df)
    edges = sorted((r["source"], r["sentiment"], r["seq"]["position"]) for r in ex.explode_relationships(nested).collect())
    assert edges == [("a", None, 1), ("c", "H", 3)]
    assert sorted((r["entity"], r["entity_type"]) for r in ex.explode_entities(nested).collect()) == [("a", "people"), ("b", "people")]


def test_lexicon_join_equals_the_set_test(spark, monkeypatch):
    df = articles(spark, [(1, "a", "Is was  IS not"), (2, "b", None), (3, "c", "none here")])
    lexicon = spark.createDataFrame([("is", "VERB"), ("Was", "VERB"), ("not", "ADV")], "token string, tag string")
    short = sorted(map(tuple, ex.count_lexicon(df, lexicon).collect()))
    monkeypatch.setattr(ex, "SHORT_LEXICON", 1)
    assert sorted(map(tuple, ex.count_lexicon(df, lexicon).collect())) == short == [(1, 3), (2, 0), (3, 0)]


def test_gazetteer(spark):
    df = articles(spark, [(1, "a", "Ann met the Green Party in Berlin. Berlin, Ann and ann!"), (2, "b", "nobody")])
    mentions = sorted((r["sentence"], r["entity"], r["position"]) for r in ex.gazetteer_mentions(df, GAZETTEER).collect())
    assert mentions == [(0, "ann", 1), (0, "berlin", 7), (0, "green party", 4), (1, "ann", 2), (1, "ann", 4), (1, "berlin", 1)]
    linked = sorted((r["source"], r["target"], r["n"]) for r in ex.cooccurrence_edges(df, GAZETTEER).collect())
    assert linked == [("ann", "green party", 1), ("berlin", "ann", 1), ("green party", "berlin", 1)]  # entries of two words are linked too
    reply = {r["url"]: json.loads(r["response_text"]) for r in ex.gazetteer_extractor(GAZETTEER)(df).collect()}
    assert reply["a"]["entities"] == {"locations": ["berlin"], "people": ["ann"], "political_parties": ["green party"]}
    assert reply["b"] == {}


def test_incremental_runs_resume(spark):
    source, sink, errors, state = (work_path(spark, n) for n in ("in", "sink", "errors", "state"))
    text = "Ann saw Berlin"

    def run():
        stream = jobs.stream_parquet(spark, source, articles(spark, []).schema)
        jobs.incremental_extract(stream, ex.gazetteer_extractor(GAZETTEER), sink, errors, state).awaitTermination()
        return jobs.read_sink(spark, sink, jobs.RESULTS)

    articles(spark, [(1, "a", text), (2, "b", text), (3, "b", None)]).write.parquet(source)
    assert sorted(r["url"] for r in run().collect()) == ["a"]
    articles(spark, [(4, "a", "changed"), (5, "c", text)]).write.mode("append").parquet(source)
    found = run()
    assert sorted((r["url"], r["batch"]) for r in found.collect()) == [("a", 0), ("c", 1)]
    assert found.filter("url = 'a'").first()["extracted_entities"] == found.filter("url = 'c'").first()["extracted_entities"]
    assert run().count() == 2


def test_arriving_files_follow_the_texts(spark, monkeypatch):
    """40 texts of 1,000 characters, 2,000 in a file: 20 files at least, taken in two batches a run."""
    sf, batches, original = work_path(spark, "sf"), [], jobs.stream_parquet

    def arrived(session, folder, schema, files_per_batch):
        batches.append((len(session.read.parquet(folder).inputFiles()), files_per_batch))
        return original(session, folder, schema, files_per_batch)

    rows = [(i, "Ann saw " + "x" * 992, "en", f"s{i}", i) for i in range(40)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int").write.parquet(f"{sf}/documents.parquet")
    monkeypatch.setattr(extraction_queries, "CHARS_PER_FILE", 2000, raising=False)
    monkeypatch.setattr(jobs, "stream_parquet", arrived)
    found = extraction_queries.run_stream(spark, sf)
    assert found.filter("what = 'article'").count() == 40
    assert batches[0][0] > 4 and batches[0][1] == 10


def test_streamed_days_equal_the_batch(spark):
    """Days far apart in any order of files, so that most rows come late; rows without a day or value too."""
    rows = [(dt.datetime(2024, 1 + i % 11, 1 + i % 5, i % 24), f"k{i % 2}", float(i)) for i in range(200)]
    rows += [(None, "k0", 1.0), (dt.datetime(2024, 1, 1), None, None), (dt.datetime(2025, 1, 1), "k0", None)]
    batch = spark.createDataFrame(rows, "ts timestamp, kind string, value double")
    source = work_path(spark, "days")
    batch.repartition(6).write.parquet(source)

    def stream():
        return jobs.stream_parquet(spark, source, batch.schema, files_per_batch=2)

    counts, means = work_path(spark, "counts"), work_path(spark, "means")
    jobs.daily_counts(stream(), "ts", ["kind"], counts, work_path(spark, "s")).awaitTermination()
    jobs.daily_means(stream(), "ts", "value", means, work_path(spark, "s")).awaitTermination()
    found = jobs.total_counts(spark.read.parquet(counts), ["kind"])
    expected = batch.selectExpr("to_date(ts) as date", "kind").groupBy("date", "kind").count()
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)
    assert spark.read.parquet(counts).select("batch").distinct().count() > 1
    mean = {r["date"]: r["mean"] for r in jobs.total_means(spark.read.parquet(means)).collect()}
    wanted = {r[0]: r[1] for r in batch.groupBy(batch.ts.cast("date")).avg("value").collect()}
    assert mean.keys() == wanted.keys() and mean.pop(dt.date(2025, 1, 1)) is None and wanted.pop(dt.date(2025, 1, 1)) is None
    assert mean == pytest.approx(wanted)


def test_first_arrivals(spark):
    """Late rows take the place of later ones, whatever file they came in; a row without a time stays only if it is alone."""
    rows = [(dt.datetime(2024, 12 - i % 12, 1, i % 24), f"u{i % 5}", i) for i in range(60)] + [(None, "u0", 60), (None, "v", 61)]
    source, sink = work_path(spark, "arrivals"), work_path(spark, "unique")
    batch = spark.createDataFrame(rows, "ts timestamp, url string, n int")
    batch.repartition(5).write.parquet(source)
    stream = jobs.stream_parquet(spark, source, batch.schema, files_per_batch=1)
    jobs.first_arrivals(stream, ["url"], "ts", sink, work_path(spark, "s")).awaitTermination()
    written = spark.read.parquet(sink)
    assert written.select("batch").distinct().count() > 1
    found = {(r["url"], r["ts"], r["n"]) for r in jobs.earliest(written.drop("batch"), ["url"], "ts").collect()}
    first = {u: min((t, n) for t, v, n in rows if v == u and t) for u in {u for _, u, _ in rows} - {"v"}}
    assert found == {(u, t, n) for u, (t, n) in first.items()} | {("v", None, 61)}


def test_latest_rows_whatever_the_order_of_files(spark):
    """A hundred small files in any order, nine at a time; spans are merged and the result is that of the batch form."""
    generator = np.random.default_rng(1)
    rows = [(f"u{generator.integers(40)}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=int(h)), i) for i, h in enumerate(generator.integers(0, 500, 1500))]
    rows += [("u0", None, -1), ("only", None, -2), (None, dt.datetime(2025, 1, 1), -3)]
    batch = spark.createDataFrame(rows, "url string, ts timestamp, n bigint")
    source = work_path(spark, "shuffled")
    batch.repartition(100).write.parquet(source)
    stream = jobs.stream_parquet(spark, source, batch.schema, files_per_batch=9)
    sink = jobs.last_arrivals(stream, ["url"], "ts", work_path(spark, "latest"), fan=3)
    jobs.reduced(stream, sink, work_path(spark, "state")).awaitTermination()
    assert sink.spans() == [(0, 8), (9, 11)]
    expected = sorted(map(tuple, jobs.latest(batch, ["url"], "ts").collect()), key=str)
    assert len(expected) == 42 and sorted(map(tuple, sink.read().collect()), key=str) == expected
    # a batch repeated after its span was merged, and a merge that did not end
    sink.write(batch.limit(0), 4)
    batch.limit(5).write.parquet(f"{sink.path}/span=9-17")
    sink._files.delete(sink._location("span=9-17/_SUCCESS"), False)
    assert sink.spans() == [(0, 8), (9, 11)] and sorted(map(tuple, sink.read().collect()), key=str) == expected


def test_taggers_start_once_a_worker(spark):
    df = articles(spark, [(i, "u", "Runs is\nRUNS" if i % 3 else None) for i in range(50)]).repartition(4)

    def start():
        time.sleep(0.01)
        return lambda texts: [["VERB" if t.lower() == "runs" else "X" for t in text.split()] for text in texts]

    found = {r["seq"]: r["count"] for r in ex.count_tags(df, "runs", start, texts_per_batch=7).collect()}
    assert found == {i: 2 if i % 3 else 0 for i in range(50)}
    assert ex.count_tags(df.limit(0), "runs", start).count() == 0


def test_pending(spark):
    df = articles(spark, [(1, "a", "x"), (2, "b", "y")])
    assert [r["url"] for r in pending(df, spark.createDataFrame([("a",), ("a",)], "url string")).collect()] == ["b"]


def test_graph_tables_from_articles(spark):
    features = spark.createDataFrame(
        [(1, "a", dt.date(2024, 1, 1), 1), (2, "b", dt.date(2024, 1, 2), 0), (3, "c", dt.date(2024, 1, 3), 1)],
        "seq bigint, url string, date date, relevance_text int",
    )
    relation = [{"source": "x", "target": "y", "relationship": "leads", "sentiment": "NEUTRAL"}]
    cells = [("a", '{"people": ["x"]}', json.dumps(relation)), ("b", '{"people": ["x"]}', json.dumps(relation)), ("c", '{"people": ["x"]}', "[]")]
    edges, entities = views.build_graph_tables(
        features, spark.createDataFrame(cells, "url string, extracted_entities string, entity_relationships string")
    )
    assert [(r["source"], r["target"], r["url"]) for r in edges.collect()] == [("x", "y", "a")]
    assert [(r["entity"], r["url"]) for r in entities.collect()] == [("x", "a")]
