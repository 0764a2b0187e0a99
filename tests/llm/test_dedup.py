"""MinHash, suffix, line and embedding deduplication against brute force and planted cases."""

import hashlib
import os
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsweave.llm import embedding_dedup, line_dedup, minhash_dedup, queries, suffix_dedup
from newsweave.llm.components import connected
from newsweave.llm.minhash_dedup import fast_sketch
from newsweave.session import application_folder

VOCABULARY = [f"w{i}" for i in range(400)]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def near_texts(seed=1):
    rng = random.Random(seed)
    rows = []
    for _ in range(12):
        base = [rng.choice(VOCABULARY) for _ in range(rng.choice([6, 40, 120]))]
        for _ in range(rng.randint(1, 7)):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 25))):
                own[rng.randrange(len(own))] = rng.choice(VOCABULARY)
            rows.append(" ".join(own))
    rows += [rows[0].upper(), rows[1] + "\t\n", "", "   ", None, "one", "ONE", "one two", "ONE  two", "two one"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def grouped(ids, links):
    least = {i: i for i in ids}
    while True:
        before = dict(least)
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
        if before == least:
            return least


def sets_of(rows, width):
    found = {}
    for i, text in rows:
        words = words_of(text)
        found[i] = {tuple(words[j : j + width]) for j in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} - {()}
    return found


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates_like_brute_force(docs_of, width, percent):
    rows = near_texts()
    sets = sets_of(rows, width)
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    least = grouped(sets, links)
    expected = {(i, len(sets[i]), least[i], least[i] == i) for i in sets}
    found = minhash_dedup.near_duplicates(docs_of(rows), width, percent)
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found.collect()} == expected
    assert len(set(least.values())) < len(least)


def test_blocks_find_what_stars_miss(docs_of, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK", 3)
    test_near_duplicates_like_brute_force(docs_of, 3, 85)


def test_near_duplicates_of_repeated_and_null_ids(docs_of):
    text = " ".join(VOCABULARY[:50])
    rows = [(7, text), (7, text), (3, text.upper()), (None, text), (None, "only here and there"), (9, None)]
    found = minhash_dedup.near_duplicates(docs_of(rows), 3, 85).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.component_id, r.kept) for r in found if r.n_shingles == 48) == [
        (False, 3, 3, True), (False, 7, 3, False), (False, 7, 3, False), (True, 0, 3, False),
    ]
    kept = minhash_dedup.drop_near_duplicates(docs_of(rows), 3, 85)
    assert kept.columns == ["doc_id", "text", "node", "line", "source"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "9", "None"]
    assert minhash_dedup.near_duplicates(docs_of([])).count() == 0


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(3)
    for size in (1, 2, 5, 1000):
        assert (fast_sketch(rng.integers(1, 1 << 63, size, np.uint64)) < 1 << 62).all()
    a = rng.integers(1, 1 << 63, 3000, np.uint64)
    b = np.concatenate([a[:2700], rng.integers(1, 1 << 63, 300, np.uint64)])
    assert abs((fast_sketch(a) == fast_sketch(b)).mean() - 2700 / 3300) < 0.12


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(5, i) for i in range(6, 60)] + [(70, 70)]
    found = {r.node: r.root for r in connected(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert {found[i] for i in range(100, 141)} == {100} and {found[i] for i in range(5, 60)} == {5} and 70 not in found


def repeats(rows, length):
    texts = {i: (t or "").encode() for i, t in rows}
    seen = Counter(t[s : s + length] for t in texts.values() for s in range(len(t) - length + 1))
    out = set()
    for i, t in texts.items():
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - length + 1):
            if seen[t[s : s + length]] > 1:
                gone[s : s + length] = True
        rest = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.add((i, len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(rest).hexdigest()))
    return out


def repeated_texts():
    rng = random.Random(4)
    pool = ["".join(rng.choice("abcdéf ") for _ in range(rng.randint(20, 90))) for _ in range(12)]
    rows = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 6))) for _ in range(60)]
    return list(enumerate([*rows, "a" * 150, "ab" * 60, None, "", rows[0], "x" + rows[1]]))


@pytest.mark.parametrize("batches", [1, 4, 5])
def test_suffix_dedup_like_brute_force(docs_of, batches):
    rows = repeated_texts()
    found = suffix_dedup.without_repeats(docs_of(rows), length=40, gram=16, batches=batches).collect()
    assert {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == repeats(rows, 40)
    texts = {i: (t or "").encode() for i, t in rows}
    assert all(len(r.kept) + r.n_removed == len(texts[r.doc_id]) for r in found)


def test_stretches_cover_every_window_once_wherever_texts_lie():
    """Against a plain search for anchors; texts handled together or alone give the same stretches."""
    length, gram = 40, 16
    raw = [(t or "").encode() for _, t in repeated_texts()]
    found = suffix_dedup.Stretches(raw, length, gram)
    assert (found.windows > 0).all()
    windows, anchors = [], {}
    hashes = found.window_hashes(np.arange(len(found.first)))
    assert [len(h) // 8 for h in hashes] == found.windows.tolist()
    for text, offset, n, ahead, own in zip(found.text, found.offset, found.windows, found.anchor - found.first, hashes, strict=True):
        for k, h in enumerate(np.frombuffer(own, np.int64).tolist()):
            windows.append((text, offset + k))
            string = raw[text][offset + k : offset + k + length]
            # equal windows have equal anchors and hashes, different ones different hashes
            assert anchors.setdefault(string, (ahead - k, h)) == (ahead - k, h)
    assert sorted(windows) == [(i, s) for i, t in enumerate(raw) for s in range(len(t) - length + 1)]
    assert len({h for _, h in anchors.values()}) == len(anchors)
    alone = [suffix_dedup.Stretches([t], length, gram) for t in raw]
    for name in ("offset", "windows", "beginning", "stretch"):
        assert getattr(found, name).tolist() == [x for one in alone for x in getattr(one, name).tolist()]
    some = np.array([0, 3, 4])
    assert found.window_hashes(some) == [hashes[i] for i in some] and found.window_hashes(some[:0]) == []


def test_slabs_stay_small_and_are_sent_together(monkeypatch):
    rows = [t.encode() for _, t in repeated_texts() if t] * 3000
    sizes, stretches = [], suffix_dedup.Stretches

    def watched(raw, length, gram):
        sizes.append(sum(map(len, raw)))
        return stretches(raw, length, gram)

    monkeypatch.setattr(suffix_dedup, "Stretches", watched)
    parts = [{"text": text, "place": place} for _, text, place in suffix_dedup._scan(rows, 40, 16)]
    assert sum(sizes) == sum(map(len, rows)) and max(sizes) <= 1 << 16
    frames = list(suffix_dedup._together(iter(parts)))
    assert sum(map(len, frames)) == sum(len(p["text"]) for p in parts) and len(frames) == -(-len(parts) // 8)
    assert list(suffix_dedup._together(iter([]))) == []


def test_tables_on_the_way_go_when_the_spans_are_written(spark, docs_of):
    def tables():
        folder = application_folder(spark)
        return {where for where, _, files in os.walk(folder) if any(f.endswith(".parquet") for f in files)}

    rows = repeated_texts()
    before = tables()
    spans = suffix_dedup.repeated_spans(docs_of(rows), 40, 16)
    left = tables() - before
    assert len(left) == 1 and len(spans.inputFiles()) > 0
    assert {os.path.dirname(f.removeprefix("file://")) for f in spans.inputFiles()} == left


def test_suffix_groups_are_divided_and_texts_sliced(docs_of, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP", 2)
    monkeypatch.setattr(suffix_dedup, "_SLICE", 64)
    test_suffix_dedup_like_brute_force(docs_of, 2)


def test_shared_passage_is_not_gathered_in_one_task(spark, docs_of, monkeypatch):
    rng = random.Random(11)
    some = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage = some(60)
    rows = [(i, some(80) + passage + some(80)) for i in range(200)]
    edges, tasks = suffix_dedup._edge_spans, []

    def watched(*args):
        spans = edges(*args)
        tasks.append(Counter(r[0] for r in spans.select(F.spark_partition_id()).collect()))
        return spans

    monkeypatch.setattr(suffix_dedup, "_edge_spans", watched)
    docs = docs_of(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = suffix_dedup.without_repeats(docs, length=40, gram=16).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == repeats(rows, 40)
    assert max(tasks[0].values()) < 0.3 * tasks[0].total()


def test_suffix_index_merges_like_a_counter(spark, docs_of):
    index = suffix_dedup.SuffixIndex(spark, 40, 16)
    for i in range(5):
        index.add(docs_of([(i, "".join(random.Random(i % 3).choice("abc") for _ in range(300)))]))
    assert sorted(index.levels) == [0, 2]
    assert index.repeated().count() > 0
    again = suffix_dedup.without_repeats(docs_of([(1, "q" * 3 + "".join(map(chr, range(200, 500)))), (1, None), (None, "z")]))
    assert {(r.doc_id, r.n_removed) for r in again.collect()} == {(1, 0), (None, 0)}
    assert suffix_dedup.without_repeats(docs_of([])).count() == 0


def edited_lines():
    rng = random.Random(5)
    base = ["".join(rng.choice("abé ") for _ in range(rng.randint(18, 40))) for _ in range(30)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(rng.randint(0, 8)):
            line = list(rng.choice(base))
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(line))
                line[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "b"])
            lines.append("".join(line))
        rows.append((i, "\n".join(lines)))
    return rows


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def test_lines_like_brute_force(docs_of):
    rows = edited_lines()
    lines = [(i, j, s.strip()) for i, t in rows for j, s in enumerate(t.split("\n")) if len(s.strip()) >= 20]
    expected = defaultdict(set)
    for i, j, s in lines:
        if any((a, b) < (i, j) and abs(len(s) - len(o)) < 2 and distance(s, o) <= 1 for a, b, o in lines):
            expected[i].add(j)
    found = line_dedup.dropped_lines(docs_of([*rows, (None, rows[3][1]), (900, None), (901, "")]), 20, 20).collect()
    assert {r.doc_id: set(r.places) for r in found} == dict(expected)
    assert sum(r.near for r in found) > 5
    texts = {r.doc_id: r.kept_sha256 for r in line_dedup.line_report(docs_of(rows), 20, 20).collect()}
    rest = {i: "\n".join(s for j, s in enumerate(t.split("\n")) if j not in expected[i]) for i, t in rows}
    assert texts == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in rest.items()}


def test_registered_query_compares_short_lines(spark, docs_of, monkeypatch):
    rng = random.Random(6)
    words = ["Les.", "Lis.", "}", "Read more", "Share this", "Share thi", "With, to to.", "With to to.", "a line of 19 chars.", "a line of 19 chars.!", "", "  "]
    rows = [(i, "\n".join(rng.choice(words) for _ in range(rng.randint(1, 6)))) for i in range(25)]
    lines = [(i, j, s.strip()) for i, t in rows for j, s in enumerate(t.split("\n")) if s.strip()]
    gone = Counter()
    for i, j, s in lines:
        gone[i] += any((a, b) < (i, j) and (s == o or min(len(s), len(o)) >= 11 and distance(s, o) == 1) for a, b, o in lines)
    monkeypatch.setattr(queries, "_table", lambda *_: docs_of(rows))
    found = {r.doc_id: (r.n_lines, r.n_removed) for r in queries.op7_line_dedup(spark, "").collect()}
    assert found == {i: (t.count("\n") + 1, gone[i]) for i, t in rows}


def test_rows_that_share_an_id_lose_their_own_lines_only(spark):
    a, b = "a line that stands in many documents", "a text of its own, quite long"
    rows = [(1, a), (5, a), (5, b), (6, f"{b}\n{a}"), (7, "x y z"), (7, "x y z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = Counter((r.doc_id, r.text) for r in line_dedup.drop_repeated_lines(docs).collect())
    assert found == Counter([(1, a), (5, b), (7, "x y z"), (7, "x y z")])


def test_documents_without_repeated_lines(spark):
    line, other = "a line that stands in many documents", "a text of its own, quite long"
    rows = [(1, f"{line}\n{other}", 5), (2, f"{line}\nshort\n{line}!", 6), (3, line, 7), (None, line, 8), (4, None, 9), (5, "", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint")
    found = {r.doc_id: (r.text, r.n_chars) for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert found == {1: (f"{line}\n{other}", 5), 2: ("short", 5), None: (line, 8), 4: (None, 9), 5: ("", 1)}
    assert line_dedup.line_report(docs.limit(0)).count() == 0


def vectors(count=120):
    rng = np.random.default_rng(2)
    middle = rng.normal(size=(12, 16))
    rows = [(middle[i % 12] + rng.normal(size=16) * (0.02 if i % 3 else 1.0)).tolist() for i in range(count)]
    odd = [None, [0.0] * 16, [float("nan")] * 16, [None] + [1.0] * 15, [float("inf")] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    return list(enumerate([*rows, *odd, rows[1], rows[1], [3 * x for x in rows[2]]]))


@pytest.mark.parametrize("shard,block", [(1500, 4000), (30, 4000), (60, 25)])
def test_embeddings_like_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(embedding_dedup, "SHARD", shard)
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rows = vectors()
    fine = {i: np.array(v, float) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    links = [(a, b) for a, b in combinations(fine, 2) if len(fine[a]) == len(fine[b]) and fine[a] @ fine[b] / np.linalg.norm(fine[a]) / np.linalg.norm(fine[b]) >= 0.9]
    least, n = grouped([i for i, _ in rows], links), Counter(x for pair in links for x in pair)
    found = embedding_dedup.near_vectors(spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<float>, node string")).collect()
    assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in found} == {(i, n[i], least[i], least[i] == i) for i, _ in rows}


def test_poor_search_of_a_small_table_is_audited(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "range_search", lambda *_: np.zeros(0, np.int64))
    found = embedding_dedup.near_vectors(spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0])], "vec_id bigint, embedding array<float>"))
    assert {(r.vec_id, r.n_links, r.component_id) for r in found.collect()} == {(1, 1, 1), (2, 1, 1), (3, 0, 3)}


def test_audit_sees_lost_links_of_small_groups(spark):
    nodes, found = [], []
    for i in range(60):  # a group of alike vectors, whose links are all found
        nodes.append((i, [1.0, 0.001 * i, 0.0, 0.0], 1))
        found.append((i, 0, 59))
    nodes += [(100, [0.0, 0.0, 1.0, 0.0], 1), (101, [0.0, 0.0, 1.0, 0.1], 1)]  # a pair, whose link is lost
    nodes = spark.createDataFrame(nodes, "node bigint, vector array<double>, copies bigint")
    links = spark.createDataFrame(found, "node bigint, root bigint, links bigint")
    assert embedding_dedup.audit_recall(nodes, links, 0.9) == 0
    whole = links.unionByName(spark.createDataFrame([(100, 100, 1), (101, 100, 1)], links.schema))
    assert embedding_dedup.audit_recall(nodes, whole, 0.9) == 1


def test_no_embeddings(spark):
    assert embedding_dedup.near_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0
    found = embedding_dedup.near_vectors(spark.createDataFrame([(None, [1.0]), (2, [1.0])], "vec_id bigint, embedding array<float>")).collect()
    assert {(r.vec_id, r.n_links, r.kept) for r in found} == {(None, 0, True), (2, 0, True)}
