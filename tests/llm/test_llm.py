"""The corpus operators against plain versions, and their defined results on odd rows."""

import hashlib
import re
import string
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash

from ledgerlark.llm import flac, fmindex, gam, langid, license_scan, merkle, mixing, packing, queries, simhash, suffix, windows

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
ODD = [
    (7, "The same passage of more than thirteen words stands here, in this text and in the next one. " * 3, "en", "a", 1, "x"),
    (3, "The same passage of more than thirteen words stands here, in this text and in the next one. " * 2 + "End", "en", None, 2, "x"),
    (3, "repeated id", None, "b", None, "y"),
    (None, "no id", "fr", "a", 5, "y"),
    (9, None, "de", "a", 0, None),
    (10, "", None, None, None, None),
    (11, " \n\t ", "en", "c", 4, "z"),
    (12, "a" * 70_000 + " " + "é" * 500, "fr", "c", 70_501, "z"),
    (13, "mit license GNU General Public License and apache   LICENSE", "en", "a", 1, "x"),
    (-4, "été über ñandú — \U0001f600 \x00 end", "es", "b", 1, "x"),
]
#: `bucket`, `label` and `words` clash with names that operators use inside.
DDL = "doc_id long, text string, lang string, source string, n_chars long, bucket string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DDL)


def long_rows():
    """A text over every part, chunk and bucket that operators work by, one that repeats a part of it, and a short one."""
    rng = np.random.default_rng(5)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in ("a", "é", "ou") for c in ("n.", "rt", "ll,", "s\n", "nd", "")]
    long = " ".join(words[i] for i in rng.integers(0, len(words), 560_000)) + " released under the MIT License."
    rows = [(5, long, "en", "a", len(long)), (2, "Before. " + long[1_000_000:1_400_000] + " after", "en", "b", 400_014), (9, "short text", "en", "a", 10)]
    return [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r, strict=True)) for r in rows]


@pytest.fixture(scope="module")
def long(spark):
    return spark.createDataFrame([(*r.values(), "x") for r in long_rows()], DDL)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def rows():
    return sorted(pq.read_table(f"{SF}/documents.parquet").to_pylist(), key=lambda r: r["doc_id"])


def odd_rows():
    return [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r, strict=False)) for r in ODD]


def plain_dedup(rows, tokens, join, length):
    """Per row: tokens, which of them go, by the definition."""
    first = {}
    own = [tokens(r["text"] or "") for r in rows]
    at = [windows.NO_ID if r["doc_id"] is None else r["doc_id"] for r in rows]
    for t, i in zip(own, at, strict=True):
        for k in range(len(t) - length + 1):
            w = join(t[k : k + length])
            first[w] = min(first.get(w, windows.NO_ID), i)
    out = []
    for t, i in zip(own, at, strict=True):
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if first[join(t[k : k + length])] < i:
                gone[k : k + length] = b"\1" * length
        out.append((t, bytes(gone)))
    return out


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize("which", ["docs", "odd", "long"])
def test_op2_against_plain(request, rows, which):
    df, rows = request.getfixturevalue(which), {"docs": rows, "odd": odd_rows(), "long": long_rows()}[which]
    want = []
    for r, (t, gone) in zip(rows, plain_dedup(rows, lambda s: WORD.findall(s.encode()), tuple, 13), strict=True):
        kept = b" ".join(x for x, g in zip(t, gone, strict=True) if not g)
        want.append((r["doc_id"], len(t), sum(gone), hashlib.sha256(kept).hexdigest()))
    assert sorted(map(tuple, fmindex.dedup_digest(df).collect()), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("which", ["docs", "odd", "long"])
def test_op10_against_plain(request, rows, which):
    df, rows = request.getfixturevalue(which), {"docs": rows, "odd": odd_rows(), "long": long_rows()}[which]
    want = []
    for r, (t, gone) in zip(rows, plain_dedup(rows, str.encode, bytes, 50), strict=True):
        kept = bytes(x for x, g in zip(t, gone, strict=True) if not g)
        want.append((r["doc_id"], len(t), sum(gone), len(re.findall(b"\1+", gone)), hashlib.sha256(kept).hexdigest()))
    assert sorted(map(tuple, suffix.dedup_digest(df).collect()), key=key) == sorted(want, key=key)


def test_op10_texts(odd):
    got = suffix.dedup_texts(odd)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    by = defaultdict(list)
    for r in got.collect():
        by[r.doc_id].append(r)
    assert by[9][0].text is None and by[9][0].n_chars == 0 and by[10][0].text == ""
    assert by[7][0].text == "" or "passage" not in by[7][0].text
    assert by[3][0].text.endswith("End") or by[3][1].text.endswith("End")


@pytest.mark.parametrize("seed", range(30))
def test_induced_sorting(seed):
    rng = np.random.default_rng(seed)
    n, k = int(rng.integers(0, 80)), int(rng.choice([1, 2, 4, 40]))
    s = np.append(rng.integers(1, k + 1, n), 0).astype(np.uint16)
    assert suffix.suffix_array(s, k + 1).tolist() == sorted(range(n + 1), key=lambda i: s[i:].tolist())


@pytest.mark.parametrize("seed", range(20))
def test_indexes_agree_with_plain(seed):
    rng = np.random.default_rng(seed)
    texts = list({b" ".join(rng.choice([b"a", b"b", b"cc"], int(rng.integers(4, 20)))) for _ in range(8)})
    ids = rng.integers(0, 50, len(texts))
    for solve, tokens in ((fmindex.least_ids, lambda t: t.split(b" ")), (suffix.least_ids, lambda t: [t[i : i + 1] for i in range(len(t))])):
        best = {}
        for t, i in zip(texts, ids, strict=True):
            own = tokens(t)
            for k in range(len(own) - 3):
                w = tuple(own[k : k + 4])
                best[w] = min(best.get(w, 99), i)
        got, count = solve(texts, ids, 4)
        assert got.tolist() == [best[tuple(tokens(t)[k : k + 4])] for t in texts for k in range(len(tokens(t)) - 3)]
        assert count.tolist() == [len(tokens(t)) - 3 for t in texts]


@pytest.mark.parametrize("seed", range(10))
def test_matching_statistics_and_places(seed, monkeypatch):
    """Against the definitions: how much of what ends at a place occurs elsewhere too, where, and the samples' walks."""
    monkeypatch.setattr(fmindex, "SAMPLE", int(seed % 3) + 1)
    rng = np.random.default_rng(seed)
    seq = np.concatenate([np.append(rng.integers(1, 4, int(rng.integers(1, 12))), 0) for _ in range(6)])
    index = fmindex.FMIndex(seq)
    order = sorted(range(len(seq)), key=lambda i: [(x, j if x == 0 else 0) for j, x in enumerate(seq[i:].tolist(), i)])
    assert index.places(np.arange(len(seq))).tolist() == order
    last = np.flatnonzero(seq)
    matched, lo, hi = fmindex.statistics(index, seq, last, 3)
    for e, m, a, b in zip(last.tolist(), matched.tolist(), lo.tolist(), hi.tolist(), strict=True):
        start = max(i for i in range(-1, e) if i < 0 or seq[i] == 0) + 1
        where = lambda n: [i for i in range(len(seq) - n + 1) if (seq[i : i + n] == seq[e - n + 1 : e + 1]).all()] if e - n + 1 >= start else []
        best = max((n for n in range(1, 4) if len(where(n)) > 1), default=0)
        assert m >= best if e - 2 < start else m == best
        if m == 3 and e - 2 >= start:
            assert sorted(order[a:b]) == where(3)


@pytest.mark.parametrize("seed", range(10))
def test_common_prefixes(seed):
    rng = np.random.default_rng(seed)
    text = np.append(rng.integers(1, 3, 120), 0).astype(np.uint8)
    sa = suffix.suffix_array(text.astype(np.uint16), 3)
    length = int(rng.choice([3, 8, 20]))
    places = np.arange(len(text)) < len(text) - length
    got = suffix.common_prefixes(text, sa, places, length)
    kept = [i for i in sa.tolist() if places[i]]
    for i, j in zip(kept, kept[1:], strict=False):
        same = next((k for k in range(length) if text[i + k] != text[j + k]), length)
        assert got[j] == same


def test_a_shard_of_a_suffix_array_is_sorted_in_little_memory():
    """Workers of the suffix-array stage share an executor with its JVM: a shard takes less than 40 bytes a byte of text (57 before)."""
    rng = np.random.default_rng(12)
    texts = [bytes(x) for x in rng.integers(97, 105, (30_000, 80), dtype=np.uint8)]
    texts += [texts[i][:60] + b"-" * 20 for i in range(0, 30_000, 7)]
    ids = rng.permutation(len(texts)) * (1 << 33)
    tracemalloc.start()
    try:
        found, count = suffix.least_ids(texts, ids)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 40 * sum(map(len, texts)), most / sum(map(len, texts))
    best = {}
    for t, i in zip(texts, ids.tolist(), strict=True):
        for a in range(31):
            best[t[a : a + 50]] = min(best.get(t[a : a + 50], i), i)
    assert count.tolist() == [31] * len(texts) and found.tolist() == [best[t[a : a + 50]] for t in texts for a in range(31)]


def test_small_tiles_give_the_same_pieces(monkeypatch):
    texts = pa.array(["one two three four five six seven eight", "", None, "two three four five six", "x"])
    for tile in (1, 3, 1 << 16):
        monkeypatch.setattr(windows, "TILE", tile)
        t = windows.word_tokens(texts)
        row, start, count, label = windows.pieces(t, 3, 2)
        every = sorted((int(r), int(s) + k) for r, s, c in zip(row, start, count, strict=True) for k in range(c))
        assert every == [(i, k) for i in range(5) for k in range(t.first[i], t.first[i + 1] - 2)]


def plain_tree(text):
    """Root, and sections of (hash, paragraphs of (hash, leaves)), by the definition."""
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    sections = []
    for part in re.split(r"(?<=\n\n)(?!\n)(?=.)", text, flags=re.S):
        paragraphs = []
        for p in re.split(r"(?<=\n)(?!\n)(?=.)", part, flags=re.S):
            leaves = [md5(x) for x in re.findall(r"[^.!?]{1,48}[.!?]*|[.!?]+", p)]
            assert "".join(re.findall(r"[^.!?]{1,48}[.!?]*|[.!?]+", p)) == p
            paragraphs.append((md5("".join(leaves)), leaves))
        sections.append((md5("".join(h for h, _ in paragraphs)), paragraphs))
    return md5("".join(h for h, _ in sections)), sections


def plain_fingerprint(tree):
    return tree[0] + "|" + ";".join(h[:16] + ":" + ",".join(g[:16] + "".join(x[:8] for x in leaves) for g, leaves in ps) for h, ps in tree[1])


def plain_likeness(one, two):
    if one[0] == two[0]:
        return 1.0
    equal = whole = 0
    for x, y in ((one, two), (two, one)):
        here, there = ({h[:16] for h, _ in t[1]} for t in (x, y))
        below = lambda t: [p for h, ps in t[1] if h[:16] not in here & there for p in ps]
        name = lambda p: p[0][:16] + "".join(h[:8] for h in p[1])
        both = set(map(name, below(x))) & set(map(name, below(y)))
        leaves = lambda t: [h[:8] for p in below(t) if name(p) not in both for h in p[1]]
        same = set(leaves(x)) & set(leaves(y))
        for h, ps in x[1]:
            for p in ps:
                whole += len(p[1])
                equal += len(p[1]) if h[:16] in here & there or name(p) in both else sum(q[:8] in same for q in p[1])
    return min(equal / max(whole, 1), 0.999999)


def plain_difference(one, two):
    if one[0] == two[0]:
        return None
    first = lambda x, y: next((i for i in range(max(len(x), len(y))) if (x[i] if i < len(x) else None) != (y[i] if i < len(y) else None)), 0)
    i = first(one[1], two[1])
    p, q = ((t[1][i][1] if i < len(t[1]) else [("", [])]) for t in (one, two))
    j = first(p, q)
    k = first(*(x[j][1] if j < len(x) else [] for x in (p, q)))
    return f"{i}.{j}.{k}"


@pytest.mark.parametrize(("range_rows", "ranges"), [(3000, 1000), (20, 1000), (10, 4)])
def test_op3(spark, docs, rows, monkeypatch, range_rows, ranges):
    """Every column against plain trees, with one range, several, and two levels of them."""
    monkeypatch.setattr(merkle, "RANGE_ROWS", range_rows)
    monkeypatch.setattr(merkle, "RANGES", ranges)
    more = ["", "a\n\nb", "a\n\n\nb", "\n\n\n", "one. two! " * 30 + "\n\n" + "x" * 200 + "?!\n\nlast\n", "é" * 100 + "\n" + "\U0001f600." * 40, "...", "s1\np\n\ns2"]
    every = rows + [{"doc_id": 10**6 + i, "text": t} for i, t in enumerate(more)]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(r["doc_id"], r["text"]) for r in every[len(rows) :]], "doc_id long, text string"))
    got = {r.doc_id: r for r in merkle.fingerprints(df).collect()}
    down = every[::-1]
    trees = [plain_tree(r["text"]) for r in down]
    for i, r in enumerate(down):
        j = (i + 1) % len(down)
        cut = len(r["text"]) // 3
        edited = r["text"][: len(r["text"]) - cut] + down[j]["text"][:cut]
        g, tree = got[r["doc_id"]], plain_tree(edited)
        assert (g.n_chars, g.edited_sha256, g.fingerprint, g.edited_fingerprint) == (len(r["text"]), hashlib.sha256(edited.encode()).hexdigest(), plain_fingerprint(trees[i]), plain_fingerprint(tree))
        assert (g.near_edited, g.near_next) == (pytest.approx(plain_likeness(trees[i], tree)), pytest.approx(plain_likeness(trees[i], trees[j])))
        assert g.first_difference == plain_difference(trees[i], tree)
    by = defaultdict(set)
    for r in every:
        by[r["text"]].add(got[r["doc_id"]].fingerprint.split("|")[0])
    assert all(len(x) == 1 for x in by.values()) and len({x for s in by.values() for x in s}) == len(by)
    assert np.mean([got[r["doc_id"]].near_edited for r in rows]) > 0.5 > 0.1 > np.mean([got[r["doc_id"]].near_next for r in rows])


def test_very_long_texts(long):
    """Trees, scores, languages, sets and cuts of a text longer than what is worked on at once."""
    rows = long_rows()
    got = {r.doc_id: r for r in merkle.fingerprints(long.select("doc_id", "text")).collect()}
    assert all(got[r["doc_id"]].fingerprint == plain_fingerprint(plain_tree(r["text"])) for r in rows)
    names, logp = langid.train(long)
    assert {r.lang_pred for r in langid.predict(long, names, logp).collect()} == {"en"}
    assert sorted(r.doc_id for r in simhash.keep_one(long).collect()) == [2, 5, 9]
    near = rows[0]["text"].replace("released under", "released, all of it, under")
    twice = long.unionByName(long.sparkSession.createDataFrame([(1, near, "en", "a", 1, "x")], DDL))
    assert sorted(r.doc_id for r in simhash.keep_one(twice).collect()) == [1, 2, 9]
    cut = {r.doc_id: r.text for r in suffix.dedup_texts(long).collect()}
    left = len(rows[0]["text"].encode()) - len(rows[0]["text"][1_000_000:1_400_000].encode())
    assert left - 10 <= len(cut[5].encode()) <= left and cut[2] == rows[1]["text"]  # a character or two beside the copy may agree too


def test_op3_odd(spark, odd, none):
    got = merkle.fingerprints(odd).collect()
    assert len(got) == len(ODD) and all(r.fingerprint and r.edited_sha256 for r in got)
    assert sorted(map(str, (r.doc_id for r in got))) == sorted(str(r[0]) for r in ODD)
    assert merkle.fingerprints(none).count() == 0
    alone = merkle.fingerprints(spark.createDataFrame([ODD[0]], DDL)).first()
    assert alone.near_next == 1.0


def plain_print(text, n=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + n]).encode(), seed=42) for i in range(max(1, len(w) - n + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


@pytest.mark.parametrize(("which", "run"), [("docs", 200_000), ("docs", 5), ("odd", 200_000), ("odd", 1), ("long", 200_000)])
def test_op4(request, rows, monkeypatch, which, run):
    monkeypatch.setattr(simhash, "RUN", run)
    df, rows = request.getfixturevalue(which), {"docs": rows, "odd": odd_rows(), "long": long_rows()}[which]
    prints = [plain_print(r["text"]) for r in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 4 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for r, g in zip(rows, group, strict=True):
        if r["doc_id"] is not None:
            least[g] = min(least.get(g, r["doc_id"]), r["doc_id"])
    want = [(r["doc_id"], f"{p:016x}", least.get(g)) for r, p, g in zip(rows, prints, group, strict=True)]
    assert sorted(map(tuple, simhash.group_digest(df).collect()), key=key) == sorted(want, key=key)


def test_op4_chain_and_tables():
    for n in (10, 10**6, 10**9, 10**12):
        masks = simhash.tables(n)
        rng = np.random.default_rng(1)
        for _ in range(200):
            x = int(rng.integers(0, 1 << 62))
            y = x
            for b in rng.choice(64, 4, replace=False):
                y ^= 1 << int(b)
            assert any(x & m == y & m for m in masks)
    values = np.array([0, 0xF, 0xFF, 0xFFF, (1 << 64) - 1], np.uint64)
    forest = simhash.Forest(values, np.zeros(5, np.int64))
    pairs = {(int(a), int(b)) for q, f in forest.near(np.arange(5), 4) for a, b in zip(q, f, strict=True) if a != b}
    assert pairs == {(0, 1), (1, 0), (1, 2), (2, 1), (2, 3), (3, 2)}


def test_op4_keeps_one(spark, odd, none):
    """One row of each group, by row and not by id: rows that repeat an id but not their words all stay."""
    kept = simhash.keep_one(odd)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(map(str, ids)) == sorted(map(str, [3, 3, None, 9, 12, 13, -4]))  # 7 is near a row of id 3
    assert simhash.keep_one(none).count() == 0
    text = [" ".join(f"{c}{i}" for i in range(40)) for c in "abcdef"]
    rows = [(3, text[0]), (3, text[1]), (4, text[2]), (5, text[2]), (5, text[2]), (5, text[2]), (None, text[3]), (None, text[3]), (None, text[4]), (6, text[4]), (1, text[5]), (3, text[5] + " end"), (8, None), (7, " "), (None, "")]
    kept = simhash.keep_one(spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=key) == sorted([(3, text[0]), (3, text[1]), (4, text[2]), (None, text[3]), (6, text[4]), (1, text[5]), (7, " ")], key=key)


def shingle_set(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


@pytest.mark.parametrize(("sf", "common", "run", "small"), [("sf0.01", 4, 200_000, 1 << 19), ("sf0.001", 10**9, 200_000, 0), ("sf0.001", 1, 3, 0)])
def test_pipeline_keeps_one_of_each_similar_group(spark, monkeypatch, sf, common, run, small):
    """Against brute-force Jaccard of five-word shingles, with pairs just above and below 0.8 and near copies of near copies.

    Also with all shingles in any order, with runs that are split in cells, and without broadcasts.
    """
    monkeypatch.setattr(simhash, "COMMON", common)
    monkeypatch.setattr(simhash, "RUN", run)
    monkeypatch.setattr(simhash, "SMALL", small)
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    word = lambda i, n: " ".join(f"w{i}x{k}" for k in range(n))
    own, line = [], "one line that very many of the documents of this table have in common "
    for i in range(40):
        base = word(i, 104).split()
        own += [" ".join(base), " ".join(base[: 90 + i % 4]), " ".join(base[:60] + ["other"] + base[61:]), " ".join(base[:30] + ["A", "b"] + base[32:60] + ["c"] + base[61:])]
        own += [line + word(f"y{i}", 3 + i), " ".join(base[10:] + ["z"] * 12)]
        own += [line * 3 + word(f"v{i % 7}", 2 + i % 5), word("one long chain", 60 + i)]
    more = spark.createDataFrame([(10**6 + i, t, "en", "a", len(t)) for i, t in enumerate(own)], docs.schema)
    rows = docs.unionByName(more).collect()
    sets = [shingle_set(r.text) for r in rows]
    where, group = defaultdict(list), list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, s in enumerate(sets):
        for j in {j for x in s for j in where[x]} if s else ():
            if 9 * len(s & sets[j]) >= 4 * (len(s) + len(sets[j])):
                group[top(i)] = top(j)
        for x in s:
            where[x].append(i)
    least = {}
    for i, r in enumerate(rows):
        least[top(i)] = min(least.get(top(i), r.doc_id), r.doc_id)
    assert len(least) < len(rows) - 100
    assert sorted(r.doc_id for r in simhash.keep_one(docs.unionByName(more)).collect()) == sorted(least.values())


@pytest.mark.parametrize("cut", [1 << 21, 4096])
def test_near_copies_around_the_threshold_make_few_rows(spark, monkeypatch, cut):
    """Many texts whose pairs are about as often above as below 0.8, and long ones that share a passage: right groups, and no rows for all pairs."""
    monkeypatch.setattr(simhash, "CUT", cut, raising=False)
    random, base = np.random.default_rng(5), [f"w{i}" for i in range(150)]
    own = []
    for i in range(500):
        words = base.copy()
        for k in random.choice(150, 2, replace=False).tolist():
            words[k] = f"x{i}y{k}"
        own.append(" ".join(words))
    own += [" ".join(base[:9] + [f"l{i}z{k}" for k in range(1500 + i)]) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in enumerate(own)], "doc_id long, text string, lang string, source string, n_chars long")
    made, checkpoint = {}, simhash.shared_checkpoint

    def counted(df):
        out = checkpoint(df)
        if out.columns[:2] in (["a", "b"], ["node", "component"]):
            made[len(made)] = out.count()
        return out

    monkeypatch.setattr(simhash, "shared_checkpoint", counted)
    kept = [r.doc_id for r in simhash.keep_one(docs).select("doc_id").collect()]
    sets, group = [shingle_set(t) for t in own], np.arange(len(own))
    for i, s in enumerate(sets):
        for j in range(i):
            if group[i] != group[j] and 9 * len(s & sets[j]) >= 4 * (len(s) + len(sets[j])):
                group[group == max(group[i], group[j])] = min(group[i], group[j])
    assert 60 < len(set(group.tolist())) < 300
    assert sorted(kept) == sorted(set(group.tolist()))
    assert cut < 1 << 21 or max(made.values()) < 8 * len(own), made  # cuts meet in pairs


@pytest.mark.parametrize("small", [1 << 19, 0])
def test_components_of_small_graphs_write_few_files(spark, monkeypatch, small):
    """A file of a checkpoint costs a process; 64 files a round held a few hundred edges. A graph that is counted and small takes no rounds."""
    monkeypatch.setattr(simhash, "SMALL", small)
    rng = np.random.default_rng(11)
    pairs = [*rng.integers(-150, 150, (120, 2)).tolist(), *([i, i + 1] for i in range(1000, 1100)), *([2000, i] for i in range(2001, 2050))]
    label = {x: x for p in pairs for x in p}
    for a, b in pairs:
        old, new = max(label[a], label[b]), min(label[a], label[b])
        label = {x: new if y == old else y for x, y in label.items()}
    written, keep = [], simhash.shared_checkpoint
    monkeypatch.setattr(simhash, "shared_checkpoint", lambda df: written.append(keep(df)) or written[-1])
    changed = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        got = sorted(tuple(r) for r in simhash.components(spark.createDataFrame(pairs, "a long, b long")).collect())
        none = simhash.components(spark.createDataFrame([], "a long, b long")).collect()
        files = [df.rdd.getNumPartitions() for df in written[1:] if df.columns == ["a", "b"] or df.columns == ["id", "component"]]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == sorted((x, y) for x, y in label.items() if x != y) and none == []
    assert min(files) <= 12 and sum(n > 12 for n in files) <= 1  # the second graph's own edges are not counted yet
    assert small == 0 or len(written) == 4


@pytest.mark.parametrize("which", ["docs", "odd", "long"])
def test_op5(request, rows, which):
    df, rows = request.getfixturevalue(which), {"docs": rows, "odd": odd_rows(), "long": long_rows()}[which]
    want = []
    for r in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r["text"] or "").translate(LOWER))
        places, labels = [], set()
        for phrase, label in license_scan.BASE.items():
            own = phrase.split()
            for i in range(len(w)):
                if w[i : i + len(own)] == own:
                    places.append(i)
                    labels.add(label)
        want.append((r["doc_id"], len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))))
    got = license_scan.scan(df).collect()
    assert sorted((tuple(r[:6]) for r in got), key=key) == sorted(want, key=key)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1 for r in got)


def test_op5_takes_words_once_without_ranges(spark):
    """One expression per scan goes through the texts, and it looks characters up instead of trying ranges."""
    plan = license_scan.scan(spark.createDataFrame([(1, "MIT license")], "doc_id long, text string"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1 and len(re.findall(r"regexp_|RLIKE", plan)) == 1
    assert not re.search(r"[^\\]-", license_scan.WORD)
    ranges = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    assert all(bool(re.fullmatch(license_scan.WORD, c)) == bool(ranges.fullmatch(c)) for c in map(chr, range(0x110000)))


def plain_licences(texts):
    """Labels and score of each text: every place where a template's key phrase stands, and the IDF weight in place there."""
    own = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER)) for t in texts]
    df = Counter(w for ws in own for w in set(ws))
    idf = {w: np.log((len(own) + 1) / (df[w] + 1)) + 1e-9 for w in license_scan.vocabulary()}
    out = []
    for ws in own:
        labels, best = set(), 0.0
        for t in license_scan.TEMPLATES:
            key, tw = t.key.split(), t.words
            for p in range(len(ws)):
                if ws[p : p + len(key)] == key:
                    at = p - t.offset
                    part = sum(idf[w] for j, w in enumerate(tw) if 0 <= at + j < len(ws) and ws[at + j] == w) / sum(idf[w] for w in tw)
                    labels.add(t.label)
                    best = max(best, part)
        out.append((labels, best))
    return out


@pytest.mark.parametrize("common", ["", "mozilla eclipse affero charge unencumbered", "subject terms made available permission binary license public"])
def test_op5_labels_and_score_against_plain(spark, rows, common):
    """Whole templates, cut ones, their keys alone, other wordings, at a text's begin and end, whatever words the corpus has often."""
    texts = [f"x {t.key} y" for t in license_scan.TEMPLATES] + [t.text for t in license_scan.TEMPLATES] + [t.text[: len(t.text) * 2 // 3] for t in license_scan.TEMPLATES]
    texts += [" ".join(t.words[t.offset :]) + " and more" for t in license_scan.TEMPLATES]
    texts += ["licensed under the Mozilla Public License 2.0", "licensed under the Eclipse Public License 2.0", "MIT license, mit License; cc by cc by", "permission to go", None, "", "licenses", "écc by", "cc byé"]
    texts += [t.text + " " + " ".join(x for y in license_scan.TEMPLATES[:i] for x in y.words) for i, t in enumerate(license_scan.TEMPLATES)]
    texts += [common] * 80 + [r["text"] for r in rows]
    got = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    want = plain_licences(texts)
    for r in got:
        labels, best = want[r.doc_id]
        assert set(filter(None, r.labels.split(","))) == labels | set(filter(None, r.base_labels.split(",")))
        assert r.score == pytest.approx(best)
    assert max(b for _, b in want) > 0.99 and any(0 < b < 0.5 for _, b in want)


@pytest.mark.parametrize("which", ["docs", "odd", "long"])
def test_op6(request, rows, which):
    df, rows = request.getfixturevalue(which), {"docs": rows, "odd": odd_rows(), "long": long_rows()}[which]
    want, blocks = [], []
    for r in rows:
        b = (r["text"] or "").encode()
        p = b + bytes(max(64, -(-len(b) // 64) * 64) - len(b))
        want.append((r["doc_id"], len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])))
        blocks.append((r["doc_id"], -(-len(p) // 1024), hashlib.sha256(b"".join(i.to_bytes(8, "little") + p[i : i + 1024] for i in range(0, len(p), 1024))).hexdigest()))
    got = flac.media_digest(df).collect()
    assert sorted((tuple(r[:5]) for r in got), key=key) == sorted(want, key=key)
    assert sorted(((r.doc_id, r.n_blocks, r.blocks_sha256) for r in got), key=key) == sorted(blocks, key=key)


def test_flac_fits_predictors():
    """A wave is coded by a fitted predictor; the reader gets it back, also from a stream without seek points."""
    rng = np.random.default_rng(3)
    t = np.arange(5000)
    own = [np.clip(128 + 90 * np.sin(t / 7) + 20 * np.sin(t / 3) + rng.normal(0, 1, 5000), 0, 255).astype(np.uint8), rng.integers(0, 256, 320).astype(np.uint8), np.frombuffer(ODD[0][1].encode()[:256], np.uint8)]
    streams = flac.encode(own)
    assert len(streams[0]) < 0.7 * 5000
    _, at = flac._metadata(streams[0])
    head, _ = flac._parse_header(streams[0][at : at + 16])
    assert streams[0][at + head] >> 1 == 31 + flac.ORDER
    assert all((a == b).all() for a, b in zip(flac.decode(streams), own, strict=True))
    flac.POINTS, old = 2, flac.POINTS
    try:
        bare = flac.encode(own)
        assert len(bare[0]) == len(streams[0]) - 4 - 5 * 18
        assert all((a == b).all() for a, b in zip(flac.decode(bare), own, strict=True))
    finally:
        flac.POINTS = old
    parts = flac.blocks(streams[0], own[0])
    assert all(flac.read(parts, a, n) == own[0][a : a + n].tobytes() for a, n in ((0, 1), (1000, 100), (1024, 2048), (4990, 10), (0, 5000)))


def test_flac_streams(odd):
    rng = np.random.default_rng(2)
    own = [np.frombuffer(x, np.uint8) for x in (bytes(64), b"a" * 2048, rng.bytes(3000), bytes(1000) + b"\xff" * 24 + bytes(2000), b"\xff\0" * 700)]
    streams = flac.encode(own)
    assert all((a == b).all() for a, b in zip(flac.decode(streams), own, strict=True))
    for s, p in zip(streams, own, strict=True):
        _, at = flac._metadata(s)
        bare = s[:4] + b"\x80" + s[5:42] + s[at:]  # without seek points
        assert (flac.decode([bare])[0] == p).all()
        broken = bytearray(s)
        broken[-9] ^= 1
        with pytest.raises(ValueError):
            flac.decode([bytes(broken)])
    parts = flac.pcm_blocks(flac.stored(odd.filter("doc_id = 12"))).orderBy("first_sample").collect()
    joined = b"".join(bytes(r.pcm) for r in parts)
    assert joined.rstrip(b"\0") == ODD[7][1].encode() and [r.first_sample for r in parts] == [1024 * i for i in range(len(parts))]


def test_flac_lpc_frame():
    """A frame with an LPC subframe and two Rice partitions, written by hand."""
    x = [3, 5, 8, 12, 15, 16, 14, 9, 3, -2, -5, -6, -4, 0, 5, 9]
    coefs, shift = [7, -4], 2
    bits = ""
    put = lambda v, n: format(v & ((1 << n) - 1), f"0{n}b")
    bits += put((32 + 1) << 1, 8) + put(x[0], 8) + put(x[1], 8) + put(3, 4) + put(shift, 5) + "".join(put(c, 4) for c in coefs) + put(0, 2) + put(1, 4)
    for i in range(2, 16):
        if i in (2, 8):
            bits += put(2, 4)
        e = x[i] - ((coefs[0] * x[i - 1] + coefs[1] * x[i - 2]) >> shift)
        u = e * 2 if e >= 0 else -e * 2 - 1
        bits += "0" * (u >> 2) + "1" + put(u & 3, 2)
    bits += "0" * (-len(bits) % 8)
    head = bytes([0xFF, 0xF8, 6 << 4 | 4, 2, 0, 15])
    frame = head + bytes([flac.crc8(head)]) + int(bits, 2).to_bytes(len(bits) // 8, "big")
    frame += int(flac.crc16(np.frombuffer(frame, np.uint8), np.array([0]), np.array([len(frame)]))[0]).to_bytes(2, "big")
    pcm = bytes(v & 255 for v in x)
    info = (16).to_bytes(2, "big") * 2 + bytes(6) + (8000 << 44 | 7 << 36 | 16).to_bytes(8, "big") + hashlib.md5(pcm).digest()
    got = flac.decode([b"fLaC\x80" + (34).to_bytes(3, "big") + info + frame])[0]
    assert (got.astype(int) - 128).tolist() == x


def test_op7(spark, docs, rows, odd, none):
    names, logp = langid.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert names == ["de", "en", "es", "fr"]
    got = {r.doc_id: r for r in langid.predict(docs, names, logp).collect()}
    assert all(got[r["doc_id"]].held_out == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect() if r.lang is not None]
    found = {r.doc_id: r for r in langid.predict(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), names, logp).collect()}
    held = [found[r.doc_id].lang_pred == r.lang for r in held if found[r.doc_id].held_out]
    assert len(held) > 100 and np.mean(held) > 0.97
    by = defaultdict(list)
    for r in langid.predict(odd, names, logp).collect():
        by[r.doc_id].append(r)
    assert [by[i][0].lang_pred for i in (9, 10, 11)] == ["und"] * 3 and by[7][0].lang_pred in names
    assert all(r.lang_pred == "und" for r in langid.identify(odd.filter("lang is null")).collect())
    assert langid.predict(none, names, logp).count() == 0
    mixed = pa.array([" ".join([rows[i]["text"][:1500] for i in (next(i for i, r in enumerate(rows) if r["lang"] == x and len(r["text"]) > 1500) for x in ("en", "de"))]), "12 — 34", "é"])
    lang, score = langid.mixtures(mixed, logp)
    assert 0.2 < score[0] < 0.8


@pytest.mark.parametrize("which", ["docs", "odd", "long"])
def test_op8(request, rows, which):
    from tokenizers import Tokenizer

    df, rows = request.getfixturevalue(which), {"docs": rows, "odd": odd_rows(), "long": long_rows()}[which]
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    want = Counter()
    whole = defaultdict(list)
    for r in rows:
        whole[r["doc_id"]].append(np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4"))
    got = packing.pack(df).collect()
    by, sequences = defaultdict(list), defaultdict(list)
    for p in got:
        by[p.doc_id, p.doc_tokens].append(p)
        sequences[p.sequence_id].append(p)
    for i, texts in whole.items():
        for t in texts:
            at = 0
            for p in sorted(by[i, len(t)], key=lambda p: p.start):
                assert p.start == at and p.ids_crc32 == zlib.crc32(t[at : at + p.length].tobytes())
                at += p.length
            assert at == len(t)
            want[i] += len(t)
    used = padding = 0
    for s in sequences.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= 2048
        used, padding = used + at, padding + (0 if at & (at - 1) == 0 else 2048 - at)
    assert used == sum(want.values())
    assert which != "docs" or padding < 0.04 * used


def test_op8_cuts_are_optimal():
    rng = np.random.default_rng(4)
    old = packing.LENGTH, packing.STRIDE
    packing.LENGTH, packing.STRIDE = 16, 8
    try:
        for _ in range(50):
            bounds = np.concatenate([[0], np.cumsum(rng.integers(1, 20, 5))])
            sentences = np.unique(rng.integers(1, bounds[-1] + 1, 8))
            edge = np.unique(np.concatenate([bounds, sentences]))
            places = sorted({*edge.tolist(), *(x for a, b in zip(edge, edge[1:], strict=False) if b - a > 8 for x in range(int(a) + 8, int(b), 8))})
            price = lambda p: 0 if p in bounds else packing.SENTENCE if p in sentences else packing.ELSEWHERE
            best = {0: 0.0}
            for p in places[1:]:
                best[p] = price(p) + min(best[q] + 16 - (p - q) for q in places if q < p <= q + 16)
            got = packing.cuts(bounds, sentences, True)
            spare, packing.SPARE = packing.SPARE, 16
            got = packing.cuts(bounds, sentences, True)
            packing.SPARE = spare
            cost = sum(price(int(b)) + 16 - (int(b) - int(a)) for a, b in zip([0, *got], got, strict=False))
            assert cost == best[places[-1]]
    finally:
        packing.LENGTH, packing.STRIDE = old


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, capped = {s: 1 + i % 3 for i, s in enumerate(names)}, set()
    total = sum(sizes.values())
    while True:
        left, w = total - sum(3 * sizes[s] for s in capped), sum(weight[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and left * weight[s] / w > 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in capped else left * weight[s] / w for s in names}
        capped |= over


@pytest.mark.parametrize("which", ["docs", "odd", "long"])
def test_op9(request, rows, which):
    df, rows = request.getfixturevalue(which), {"docs": rows, "odd": odd_rows(), "long": long_rows()}[which]
    size, sources = Counter(), defaultdict(set)
    for r in rows:
        size[r["source"]] += len(WORD.findall((r["text"] or "").encode()))
        sources[r["doc_id"]].add(r["source"])
    want = plain_targets(size)
    got = mixing.mix_digest(df).collect()
    assert len(got) == len(rows) and all(0 <= r.taken <= 3 * r.size and r.taken == len(r.shards) * r.size for r in got)
    assert {round(r.target, 6) for r in got} == {round(x, 6) for x in want.values()}
    assert Counter((r["doc_id"], len(WORD.findall((r["text"] or "").encode()))) for r in rows) == Counter((r.doc_id, r.size) for r in got)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_digest(df).collect()))
    # each source takes its target, but for part of one document
    taken, most = Counter(), Counter()
    for r in got:
        taken[r.source_size, r.target] += r.taken
        most[r.source_size, r.target] = max(most[r.source_size, r.target], r.size)
    assert all(abs(taken[k] - k[1]) <= most[k] / 2 + 1 for k in taken)


def test_op9_takes_what_the_tree_gives(docs, monkeypatch):
    """The quotas of the tree are what the shards draw: shard by shard, block copy by block copy."""
    drawn = []
    split = mixing.split
    monkeypatch.setattr(mixing, "split", lambda counts, shards: drawn.append(split(counts, shards)) or drawn[-1])
    chosen, shards = mixing.plan(docs)
    copies = chosen.select("source_size", "target", mixing.F.pmod("_h", mixing.F.lit(64)).alias("block"), mixing.F.posexplode("shards").alias("p", "shard")).distinct().groupBy("source_size", "shard").count().collect()
    assert shards == 16 and sorted(r["count"] for r in copies) == sorted(drawn[0][drawn[0] > 0].tolist())
    monkeypatch.setattr(mixing, "split", lambda counts, shards: np.zeros((shards, len(counts)), np.int64))
    assert {r.taken for r in mixing.mix_digest(docs).collect()} == {0}


def test_op9_tree_and_mix(spark, odd, none, docs, monkeypatch):
    counts = np.array([100, 0, 7, 1000])
    out = mixing.split(counts, 16)
    assert (out.sum(axis=0) == counts).all() and out.sum(axis=1).max() - out.sum(axis=1).min() <= 4 and (out == mixing.split(counts, 16)).all()
    monkeypatch.setattr(mixing, "DRAW", 50)
    out = mixing.split(counts, 16)
    assert (out.sum(axis=0) == counts).all() and out.sum(axis=1).max() - out.sum(axis=1).min() <= 4
    monkeypatch.setattr(mixing, "ROWS", 2)
    twice = odd.unionAll(odd).unionAll(spark.createDataFrame([(20, "one two three", "en", "c", 1, "x")] * 9 + [(20, "four words of c", "en", "c", 1, "x"), (20, "one two three", "en", "b", 1, "x")], DDL))
    for df in (odd, twice, docs):
        mixed = mixing.mix(df)
        assert mixed.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        # the mix has whole texts, each as often as the digest says, and texts without words once
        want = Counter()
        for r in mixing.mix_digest(df).collect():
            want[r.doc_id, r.size] += r.taken // r.size if r.size else 1
        got = Counter((r.doc_id, len(WORD.findall((r.text or "").encode()))) for r in mixed.collect())
        assert got == +want
        texts = {(r.doc_id, r.text, r.source, r.n_chars) for r in df.collect()}
        assert all((r.doc_id, r.text, r.source, r.n_chars) in texts for r in mixed.collect())
    assert mixing.mix_digest(none).count() == 0 and mixing.mix(none).count() == 0
    parts = mixing.mix(docs).select("doc_id", mixing.F.spark_partition_id().alias("p")).collect()
    of = Counter((r.doc_id, s) for r in mixing.mix_digest(docs).collect() for s in r.shards)
    assert of == Counter((r.doc_id, r.p) for r in parts if (r.doc_id, r.p) in of) and sum(of.values()) >= len(parts) - 5


def test_op1(spark, odd, none):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = gam.train(docs, labels)
    got = {r.doc_id: r for r in gam.score(docs, model).collect()}
    held = [(got[r.doc_id].predicted, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert np.mean([p == q for p, q in held]) > 0.95
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in got.values())
    assert len(gam.score(odd, model).collect()) == len(ODD) and gam.score(none, model).count() == 0
    assert gam.keep_good(odd, model).columns == ["doc_id", "text", "lang", "source", "n_chars"]
    blank = gam.train(docs, labels.filter("false"))
    assert {r.score for r in gam.score(odd, blank).collect()} == {0.5}
    # the same rows in another order give the same model
    again = gam.train(docs.orderBy("text"), labels)
    assert {r.doc_id: r.score for r in gam.score(docs, again).collect()} == {i: r.score for i, r in got.items()}


def test_op1_bounds_rows_and_adds_bins(spark, monkeypatch):
    """The bound is on rows, also where one id is repeated; scores are the plain sums of table entries."""
    rows = [(1, f"text number {i} of the one id", "en", "a", 1) for i in range(300)] + [(i, f"other {i}", "en", "a", 1) for i in range(2, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)], "doc_id long, quality int")
    seen = []
    fit = gam.fit
    monkeypatch.setattr(gam, "fit", lambda x, y: seen.append((x, y)) or fit(x, y))
    gam.train(docs, labels, 25)
    gam.train(docs.orderBy("text"), labels, 25)
    assert len(seen[0][1]) == 25 and (seen[0][0] == seen[1][0]).all() and (seen[0][1] == seen[1][1]).all()
    model = gam.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    for r in gam.score(docs, model).limit(20).collect():
        x = gam.features(pa.array([dict((t, t) for _, t, *_ in rows)[next(t for i, t, *_ in rows if i == r.doc_id)]]))[0] if r.doc_id > 1 else None
        if x is not None:
            total = model.intercept + sum(t[sum(x[i] >= b for b in e)] for i, (e, t) in enumerate(zip(model.edges, model.tables, strict=True)))
            total += sum(t[sum(x[i] >= c for c in a), sum(x[j] >= c for c in b)] for i, j, a, b, t in model.pairs)
            assert r.score == pytest.approx(1 / (1 + np.exp(-total)))


def plain_mixture(text, logp):
    """Proportions by EM and the chosen set by penalised likelihood, word by word and set by set."""
    own = []
    x = text.encode()
    for i in range(len(x)):  # A-Z and capitals of Latin-1 are lower-cased, as far as bytes go
        b = x[i]
        if 0x41 <= b <= 0x5A or (i and x[i - 1] == 0xC3 and 0x80 <= b <= 0x9E and b != 0x97):
            b += 0x20
        own.append(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0)
    words, run = [], []
    for b in [*own, 0]:
        if b:
            run.append(b)
        elif run:
            ext = [0, *run, 0]
            codes = [((ext[k - 2] if k > 1 else 0) << 16 | ext[k - 1] << 8 | ext[k]) for k in range(1, len(ext))]
            words.append([(c * 2654435761 % 2**32) >> 17 for c in codes])
            run = []
    ll = np.array([logp[w].sum(axis=0) for w in words], float)
    like = np.exp(ll - ll.max(axis=1, keepdims=True))
    n = logp.shape[1]

    def em(share, rounds):
        for _ in range(rounds):
            part = like * share
            share = (part / part.sum(axis=1, keepdims=True)).mean(axis=0)
        return share, np.log((like * share).sum(axis=1)).sum()

    share, _ = em(np.full(n, 1 / n), langid.ROUNDS)
    penalty = 0.5 * np.log(len(words) + 1)
    single = (ll - ll.max(axis=1, keepdims=True)).sum(axis=0)
    best, chosen = single.max() - penalty, np.eye(n)[single.argmax()]
    order = np.argsort(-share, kind="stable")
    for k in range(2, n + 1):
        start = np.zeros(n)
        start[order[:k]] = share[order[:k]] + 1e-9
        got, fit = em(start / start.sum(), langid.SET_ROUNDS)
        if fit - k * penalty > best:
            best, chosen = fit - k * penalty, got
    return int(chosen.argmax()), float(share[chosen.argmax()])


def test_op7_against_plain_mixtures(spark, rows):
    names, logp = langid.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    texts = [r["text"][:1500] for r in rows[:60]] + [" ".join(r["text"][:400] for r in rows[i : i + 3]) for i in range(0, 60, 3)] + ["ÉTÉ and à la carte", "x"]
    lang, score = langid.mixtures(pa.array(texts), logp)
    for t, a, b in zip(texts, lang, score, strict=True):
        want, part = plain_mixture(t, logp)
        assert a == want and b == pytest.approx(part, abs=2e-3)


def test_op7_many_languages_raise(docs, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 3)
    with pytest.raises(ValueError):
        langid.train(docs)


def test_op8_other_tokenizers_encode_whole_texts():
    """A tokenizer that keeps case and white space is not fed with runs."""
    import public_tokenizers

    texts = ["The cat,  sat. On THE mat!\nNew line", "", None, "AbC 12.5"]
    for name, in_runs in (("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)):
        encoder = packing.Encoder(public_tokenizers.path(name))
        assert encoder.in_runs == in_runs
        ids, bounds, _ = encoder(pa.array(texts))
        for t, a, b in zip(texts, bounds, bounds[1:], strict=False):
            assert ids[a : b - 1].tolist() == encoder.tokenizer.encode(t or "", add_special_tokens=False).ids


def test_op8_keeps_words_apart_from_any_punctuation():
    """A word and the signs after it are one content each, however they are combined; ids are the tokenizer's."""
    encoder = packing.Encoder(packing.default_tokenizer())
    words, signs = ["wood", "naïvé", "ÉTÉ", "re", "s", "ß"], [*string.punctuation, "%%%", "$$$", "'s", "''ll", "<\u0338", ".'t"]
    encoder.clear()
    encoder(pa.array([f"{w}{x}" for w in words for x in signs]))
    assert len(encoder.known) <= len(words) + len(signs)
    texts = [f"{w}{x}{y}" for w in words for x in signs for y in ["", "a", " b", "é", "\u0301", "5"]]
    texts += ["e\u0301% a×% a÷% A\u0301' x\u00b7! 中% я' ﬁ. ǅ. a\u0338=", "", None, "\n"]
    assert encoder.in_runs
    for column in (pa.array(texts), pa.array([" ".join(filter(None, texts))])):
        ids, bounds, _ = encoder(column)
        for t, a, b in zip(column.to_pylist(), bounds, bounds[1:], strict=False):
            assert ids[a : b - 1].tolist() == encoder.tokenizer.encode(t or "", add_special_tokens=False).ids


def test_op8_takes_letters_by_the_model(monkeypatch):
    encoder = packing.Encoder(packing.default_tokenizer())
    assert encoder.in_runs and encoder.letters is not None
    texts = ["don't  É1é ×a a×b ÷ naïve STRASSE ß Àé,b", None, "cafe\u0301 e\u0301x é\u0301 ŒœŠ ÿŸ ªº İI aʼb", "a" * 3000 + " " + "é" * 3000, "mot%%% x$$$ \x00a", "zz <|endoftext|> Üb"]
    texts += [f"xq{chr(97 + i % 26)} {chr(0xC0 + i) * 3}q{i % 7} {chr(0xC0 + i)}oo" for i in range(64)]
    seen, other = [], encoder.encode_any
    monkeypatch.setattr(encoder, "encode_any", lambda fresh, plain: seen.extend(fresh) or other(fresh, plain))
    encoder.clear()
    ids, bounds, _ = encoder(pa.array(texts[6:]))
    assert seen and not any(packing.LETTERS.fullmatch(x.encode()) for x in seen)
    assert len(encoder.known) > len(seen) + 50  # capitals other than A-Z take all steps
    ids, bounds, _ = encoder(pa.array(texts))
    assert [ids[a : b - 1].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_op1_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.fit(x, y)
    assert np.mean((model.score(x) > 0.5) == (y > 0.5)) > 0.9
    assert (0, 1) in {(i, j) for i, j, *_ in model.pairs}


@pytest.mark.parametrize("f", [fmindex.dedup_digest, suffix.dedup_digest, suffix.dedup_texts, simhash.group_digest, simhash.keep_one, merkle.fingerprints, license_scan.scan, flac.media_digest, langid.identify, packing.pack, mixing.mix, mixing.mix_digest])
def test_empty_tables(none, f):
    assert f(none).collect() == []


def test_queries_are_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert set(queries.queries()) <= names and "pipeline" in names
