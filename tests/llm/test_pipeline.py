"""The whole pipeline against plain versions of its stages."""

import re
from collections import defaultdict
from itertools import combinations

import corpus_pipeline
from test_dedup import distance, grouped, sets_of
from test_scans import check_packed, contaminated


def plain_lines(rows):
    first, near, gone = {}, set(), defaultdict(set)
    lines = [(i, j, s.strip()) for i, t in rows for j, s in enumerate(t.split("\n")) if s.strip()]
    for i, j, s in sorted(lines):
        first.setdefault(s, (i, j))
    groups = defaultdict(set)
    for s in first:
        if len(s) < 11:
            continue
        for size in (len(s) // 2, (len(s) - 1) // 2):
            groups[s[:size], size].add(s)
            groups[size, s[len(s) - size :]].add(s)
    for group in groups.values():
        for a, b in combinations(group, 2):
            if abs(len(a) - len(b)) < 2 and distance(a, b) == 1:
                near.add(max(a, b, key=first.get))
    for i, j, s in lines:
        if s in near or first[s] < (i, j):
            gone[i].add(j)
    out = [(i, "\n".join(s for j, s in enumerate(t.split("\n")) if j not in gone[i])) for i, t in rows]
    return [(i, t) for i, t in out if not gone[i] or re.search(r"\S", t)]


def test_pipeline_like_plain_stages(spark, sf_dir):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "minhash_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        stages.append(corpus_pipeline.cut(stage(spark, stages[-1], sf_dir)))
        assert stages[-1].dtypes == docs.dtypes
    rows = [sorted((r.doc_id, r.text) for r in s.collect()) for s in stages]
    assert len(rows[1]) >= 0.99 * len(rows[0])  # clean documents stay
    assert rows[2] == sorted(plain_lines(rows[1]))
    sets = sets_of(rows[2], 5)
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    least = grouped(sets, links)
    assert rows[3] == [(i, t) for i, t in rows[2] if least[i] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = {x[0] for x in contaminated(rows[3], items, 10) if not x[5]}
    assert rows[4] == [(i, t) for i, t in rows[3] if i in clean]
    used, least_used = check_packed(corpus_pipeline.run(spark, sf_dir).collect(), rows[4], 2048)
    assert used <= least_used + 1
