"""Fill-in-the-middle, importance resampling and mixing against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from newsweave.llm import fim, mixing, resampling

LETTERS = ["a", "B9", "é", "the", "x" * 40, "中文", "😀", "_", "-", "\x7f", "<P", ">", "$1"]


def some_texts(count, seed, most=120):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) + rng.choice(["", " ", "\n"]) for _ in range(rng.randint(0, most))) for _ in range(count)]


@pytest.mark.parametrize("unit", [None, r"\S+\s*", r"[a-z]+"])
def test_cuts_like_plain_slices(unit):
    rng = random.Random(5)
    texts = [*some_texts(40, 1), "", "é" * 3000, "a" * (3 * fim.BLOCK), *some_texts(3, 2, 3000)]
    draws = np.array([[rng.getrandbits(32), rng.getrandbits(32)] for _ in texts])
    for lo, hi in ((0, len(texts)), (0, 1), (40, 41), (7, 30)):
        n, places, points = fim.cut_texts([t.encode() for t in texts[lo:hi]], draws[lo:hi], regex.compile(unit) if unit else None)
        for i, text in enumerate(texts[lo:hi]):
            ends = [0, *([m.end() for m in re.finditer(unit, text)] if unit else range(1, len(text) + 1))]
            first, second = (ends[k] for k in sorted(int(d) % len(ends) for d in draws[lo + i]))
            assert n[i] == len(ends) - 1 and points[i].tolist() == [first, second - first]
            assert places[i].tolist() == [len(text[:first].encode()), len(text[:second].encode())]


def middle_last(doc_id, text):
    h = [int(hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", text, None, None
    if h[3] % 100 < 20:
        return n, "spm", f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}", a, b - a
    return n, "psm", f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}", a, b - a


def test_fill_in_middle_whole_rows(docs_of):
    rows = list(enumerate(some_texts(150, 3))) + [(900, None), (901, ""), (902, "a<M>b"), (903, "<" * 50), (904, "\n" * 40), (905, "é😀" * 30_000), (None, "no id"), (4, "other text of 4"), (7, None)]
    found = fim.fill_in_middle(docs_of(rows)).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    expected = Counter((i, *middle_last(i, t or ""), t or "") for i, t in rows)
    assert Counter(tuple(r) for r in found) == expected
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    assert fim.report(docs_of([])).count() == 0


def test_fill_in_middle_by_words(docs_of):
    rows = list(enumerate(some_texts(40, 9)))
    found = fim.fill_in_middle(docs_of(rows), unit=r"\S+\s*", transform_percent=100, spm_percent=50).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    for r in found.collect():
        text = rows[r.doc_id][1]
        assert r.back == text and r.n == len(text.split())
        assert r.form == "plain" or re.fullmatch(r"(\S+\s*)*|\s+", text[: r.prefix_chars])


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def features_of(text):
    words = words_of(text)
    return [*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))]


def test_table_hashes_like_the_library():
    rng = random.Random(3)
    buffer = np.frombuffer(rng.randbytes(3000), np.uint8)
    starts, sizes = (np.array([rng.randrange(top) for _ in range(1000)]) for top in (2900, 32))
    found = resampling.xxhash64(resampling.lanes(buffer), starts, sizes)
    assert found.tolist() == [xxhash.xxh64_intdigest(buffer[s : s + n].tobytes()) for s, n in zip(starts, sizes, strict=True)]


def test_table_tells_equal_keys_apart_by_bytes():
    text = b"one two one three " + b"long" * 20 + b" " + b"long" * 19 + b"lonk one"
    spans = [m.span() for m in re.finditer(rb"\S+", text)]
    starts, sizes = (np.array(c) for c in zip(*((s, e - s) for s, e in spans), strict=True))
    table = resampling.Interned(np.frombuffer(text, np.uint8), starts, sizes, 10_000, keys=np.full(len(spans), 5, np.uint64))
    assert len(table.used) == 5 and table.count[table.slot].tolist() == [3, 1, 3, 1, 1, 1, 3]
    assert table.bucket[table.slot].tolist() == [zlib.crc32(text[s:e]) % 10_000 for s, e in spans]


@pytest.mark.parametrize("limit", [30, 200, 1 << 20])
def test_features_of_cut_texts(limit):
    texts = some_texts(40, 4)
    found, n_words = Counter(), Counter()
    for group in resampling.pieces([t.encode() for t in texts], limit):
        table, place, words = resampling.features(group)
        for (i, _, _), n in zip(group, words.tolist(), strict=True):
            n_words[i] += n
        for p, slot in zip(place.tolist(), table.slot.tolist(), strict=True):
            first = table.owner[slot]
            found[group[p][0], table.raw[table.starts[first] : table.starts[first] + table.sizes[first]].decode()] += 1
    assert found == Counter((i, f) for i, t in enumerate(texts) for f in features_of(t))
    assert n_words == Counter({i: len(words_of(t)) for i, t in enumerate(texts)})


def resampled(rows, items):
    count = lambda texts: Counter(zlib.crc32(f.encode()) % 10_000 for t in texts for f in features_of(t))
    own, target = count(t for _, t in rows), count(items)
    s_all, t_all = sum(own.values()) + 10_000.0, sum(target.values()) + 10_000.0
    scored = []
    for i, text in rows:
        gains = [math.floor(1000 * math.log((target[k] + 1.0) * s_all / ((own[k] + 1.0) * t_all))) for k in (zlib.crc32(f.encode()) % 10_000 for f in features_of(text))]
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gains) // len(gains) if gains else 0
        scored.append((i, len(gains), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words_of(text))))
    able = sorted((s for s in scored if s[4] >= 20), key=lambda s: (-s[3], s[0] is None, s[0] or 0))
    ranks = {id(s): r for r, s in enumerate(able[: len(able) * 25 // 100], 1)}
    return [(*s[:4], ranks.get(id(s))) for s in scored]


def test_resampling_like_brute_force(spark, docs_of):
    rows = list(enumerate(some_texts(200, 6))) + [(900, None), (901, ""), (902, "--- !"), (903, "a " * 30), (903, "a " * 30), (None, "b c " * 30)]
    items = [*some_texts(5, 8), None, ""]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id bigint, text string")
    found = resampling.resample(docs_of(rows), table).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert Counter(map(tuple, found)) == Counter(resampled(rows, items))
    nothing = resampling.resample(docs_of(rows), table.limit(0)).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert Counter(map(tuple, nothing)) == Counter(resampled(rows, []))
    assert resampling.resample(docs_of([]), table).count() == 0


def test_target_texts_weigh_more(spark, docs_of):
    rows = [(i, " ".join(random.Random(i).choices(["red", "green", "blue"] if i % 2 else ["one", "two", "three"], k=40))) for i in range(200)]
    table = spark.createDataFrame([(1, "red green blue " * 20)], "item_id bigint, text string")
    drawn = resampling.resample(docs_of(rows), table).where("rank IS NOT NULL").collect()
    assert len(drawn) == 50 and sum(r.doc_id % 2 for r in drawn) >= 40


def targets_of(sizes, weights=(3, 1, 2), share=1.5, most=2):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, budget = {}, share * sum(sizes.values())
    while True:
        free = [s for s in order if s not in full]
        each = {s: (budget - sum(full.values())) * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if each[s] > most * sizes[s]]
        if not over:
            return full | each
        full |= {s: most * sizes[s] for s in over}


def mixed_rows(spark, seed=1):
    rng = random.Random(seed)
    source = lambda: rng.choice(["hot"] * 6 + ["b", "Ü", "a", None, "z"])
    rows = [(i, " ".join("w" * rng.randint(1, 3) for _ in range(int(rng.lognormvariate(3, 1.2)))), source()) for i in range(3000)]
    rows += [(5000, None, "hot"), (5001, " \n", None), (None, "no id", "a"), (1 << 60, "large id", "a"), (7, "other text", rows[7][2])] + [(6000, "alike " * 9, "b")] * 40
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, source string").selectExpr("*", "'x' AS size", "1 AS times")


@pytest.mark.parametrize("block", [500, 20])
def test_mixing_meets_targets(spark, block):
    rows, docs = mixed_rows(spark)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += size(text)
    targets = targets_of(sizes)
    found = mixing.mix(docs, block=block).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in found) == Counter((i, s, size(t)) for i, t, s in rows)
    words, documents, due = Counter(), Counter(), Counter()
    for r in found:
        ratio = targets[r.source] / sizes[r.source]
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source], rel=1e-12)
        assert math.floor(ratio) <= r.times <= math.ceil(ratio) <= 2
        words[r.source] += r.size * r.times
        documents[r.source] += r.times
        due[r.source] += ratio
    for source, target in targets.items():
        assert abs(words[source] - target) <= max(2, 0.002 * target)
        assert abs(documents[source] - due[source]) <= 1.5
    assert sum(targets.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_mixing_agrees_however_it_is_dealt(spark):
    _, docs = mixed_rows(spark)
    one, two = (Counter(map(tuple, mixing.mix(d, block=50).collect())) for d in (docs.repartition(1), docs.repartition(13)))
    assert one == two
    other = Counter(map(tuple, mixing.mix(docs, block=50, seed=2).collect()))
    assert other != one


def test_chances_are_kept_on_average():
    size, chance = np.array([5.0, 1, 1, 40, 7, 7, 3, 100]), np.array([0.3, 0.5, 0.5, 0.1, 0.7, 0.7, 0.9, 0.2])
    total = np.zeros(len(size))
    for seed in range(4000):
        found = mixing.fly(size, chance, np.random.default_rng(seed).random(len(size)))
        assert ((found > 0) & (found < 1)).sum() <= 2
        assert found.sum() == pytest.approx(chance.sum()) and (found * size).sum() == pytest.approx((chance * size).sum())
        total += found
    assert np.abs(total / 4000 - chance).max() < 0.035


def test_mixture_repeats_rows(spark):
    rows, docs = mixed_rows(spark, 2)
    times = defaultdict(int)
    for r in mixing.mix(docs).collect():
        times[r.doc_id, r.source, r.size] += r.times
    found = mixing.mixture(docs)
    assert found.columns == docs.columns
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r.source, size(r.text)) for r in found.collect()) == Counter({k: n for k, n in times.items() if n})
    assert mixing.report(docs.limit(0)).count() == 0 and mixing.mixture(docs.limit(0)).count() == 0


def test_targets_of_odd_sources(spark):
    for sizes in ({"a": 10}, {None: 5, "a": 1000, "B": 3, "é": 90, "z": 0}, {"a": 0, "b": 0}, {str(i): i * i for i in range(40)}):
        table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        found = {r.source: r.target for r in mixing.source_targets(table).collect()}
        assert found == pytest.approx(targets_of(sizes))
