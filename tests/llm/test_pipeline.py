"""The pipeline's stages on the small tables, each against a plain version on its own input, and on odd and empty tables."""

import hashlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from test_llm import DDL, ODD, WORD, plain_dedup, plain_targets, shingle_set

from ledgerlark.llm import gam, packing

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def key(row):
    return tuple((x is None, x) for x in row)


def plain_quality(spark, rows):
    """Rows that the model keeps, scored one by one, bin by bin."""
    docs = spark.read.parquet(f"{SF}/documents.parquet") if len(rows) == 200 else spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    model = gam.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    out = []
    for r in rows:
        x = gam.features(__import__("pyarrow").array([r[1]]))[0]
        total = model.intercept + sum(t[sum(x[i] >= b for b in e)] for i, (e, t) in enumerate(zip(model.edges, model.tables, strict=True)))
        total += sum(t[sum(x[i] >= c for c in a), sum(x[j] >= c for c in b)] for i, j, a, b, t in model.pairs)
        if 1 / (1 + np.exp(-total)) >= 0.3:
            out.append(r)
    return out


def plain_near(rows):
    group = list(range(len(rows)))
    sets = [shingle_set(r[1]) for r in rows]
    for i, s in enumerate(sets):
        for j in range(i):
            if group[i] != group[j] and (s == sets[j] or 9 * len(s & sets[j]) >= 4 * (len(s) + len(sets[j])) > 0):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    best = defaultdict(list)
    for r, g in zip(rows, group, strict=True):
        best[g].append(r)
    return [[r for r in rs if (r[0] is None, r[0]) == min((x[0] is None, x[0] or 0) if x[0] is not None else (True, None) for x in rs)] for rs in best.values()]


def plain_passages(rows):
    dicts = [dict(zip(COLUMNS, r, strict=True)) for r in rows]
    out = []
    for r, (t, gone) in zip(dicts, plain_dedup(dicts, str.encode, bytes, 50), strict=True):
        if r["text"] is None:
            out.append(tuple(r.values()))
            continue
        at, kept = 0, ""
        for c in r["text"]:
            n = len(c.encode())
            kept += "" if any(gone[at : at + n]) else c
            at += n
        out.append((r["doc_id"], kept, r["lang"], r["source"], len(kept)))
    return out


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_stages(spark, tmp_path, which):
    docs = spark.read.parquet(f"{SF}/documents.parquet") if which == "docs" else spark.createDataFrame(ODD, DDL)
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [tuple(r) for r in docs.select(*COLUMNS).collect()]
        out = stage(spark, docs, SF)
        assert i == 4 or out.columns == COLUMNS, name
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        got = [tuple(r) for r in docs.collect()]
        if i == 0:
            assert sorted(got, key=key) == sorted(plain_quality(spark, before), key=key)
            if which == "odd":  # go on with all of them
                docs = spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long")
        if i == 1:
            groups = plain_near(before)
            assert len(got) == len(groups) and all(sum(g in rs for g in got) == 1 for rs in groups)
        if i == 2:
            assert sorted(got, key=key) == sorted(plain_passages(before), key=key)
        if i == 3:
            size = lambda r: len(WORD.findall((r[1] or "").encode()))
            total, taken, most = Counter(), Counter(), Counter()
            for r in before:
                total[r[3]] += size(r)
                most[r[3]] = max(most[r[3]], size(r))
            for r in got:
                taken[r[3]] += size(r)
            times, here = Counter(got), Counter(before)
            assert set(times) <= set(here) and all(n <= 3 * here[r] for r, n in times.items())
            assert all(times[r] == here[r] for r in here if not size(r))
            assert all(abs(taken[s] - t) <= most[s] / 2 + 1 for s, t in plain_targets(total).items())
        if i == 4:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(packing.default_tokenizer())
            count = Counter((r[0], len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1) for r in before)
            pieces = Counter()
            for r in docs.collect():
                pieces[r.doc_id, r.doc_tokens] += r.length
            assert pieces == Counter({k: k[1] * n for k, n in count.items()})


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], DDL)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        assert i == 4 or out.columns == COLUMNS
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        assert docs.count() == 0


def test_run_is_the_stages(spark, tmp_path):
    got = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
    digest = lambda df: hashlib.sha256(repr(sorted((r.doc_id, r.doc_tokens) for r in df.collect() if r.start == 0)).encode()).hexdigest()
    assert digest(got) == digest(docs) and got.columns == docs.columns
