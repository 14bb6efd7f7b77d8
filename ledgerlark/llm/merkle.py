"""Document fingerprints: a Merkle tree over sections, paragraphs and their sentences, in Spark's own functions.

Sections end after empty lines, paragraphs after line ends, which belong to them. Leaves are sentences
(one of more than 48 characters goes on in a further leaf), so that also a text of one paragraph has
branches. A leaf's hash is that of its text, a paragraph's that of its leaves' hashes, a section's that
of its paragraphs', the root's that of its sections', all of 128 bits; the leaves together are the whole
text, so equal roots mean equal texts.

The fingerprint is the tree as text: `root|section:paragraph,paragraph;section:...`, a paragraph being its
own hash and its leaves', without marks between them. The root is there whole, inner hashes by their
first 16 digits and leaves by 8, which is enough to walk two trees and find where they differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAF = r"[^.!?]{1,48}[.!?]*|[.!?]+"
NODE, LEAF_DIGITS = 16, 8
#: Rows of one range of neighbours, about, and ranges on either of two levels at most; with more rows ranges are larger.
RANGE_ROWS, RANGES = 3000, 1000


def _bound(value: Column, f) -> Column:
    """f(value), with value worked out once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def fingerprint(text: Column) -> Column:
    """The tree of a text; a null text counts as empty."""

    def paragraph(part: Column) -> Column:
        leaves = F.transform(F.regexp_extract_all(part, F.lit(LEAF), F.lit(0)), F.md5)
        return _bound(leaves, lambda own: _bound(F.md5(F.array_join(own, "")), lambda node: F.struct(node.alias("node"), F.concat(F.left(node, F.lit(NODE)), F.array_join(F.transform(own, lambda x: F.left(x, F.lit(LEAF_DIGITS))), "")).alias("tree"))))

    def above(parts: Column, before, mark: str) -> Column:
        node = F.md5(F.array_join(F.transform(parts, lambda p: p["node"]), ""))
        return _bound(node, lambda own: F.struct(own.alias("node"), F.concat(before(own), F.array_join(F.transform(parts, lambda p: p["tree"]), mark)).alias("tree")))

    def section(part: Column) -> Column:
        return _bound(F.transform(F.split(part, r"(?<=\n)(?!\n|\z)"), paragraph), lambda own: above(own, lambda node: F.concat(F.left(node, F.lit(NODE)), F.lit(":")), ","))

    sections = F.transform(F.split(F.coalesce(text, F.lit("")), r"(?<=\n\n)(?!\n|\z)"), section)
    return _bound(sections, lambda own: above(own, lambda node: F.concat(node, F.lit("|")), ";"))["tree"]


def root(print_: Column) -> Column:
    return F.substring_index(print_, "|", 1)


def _sections(print_: Column) -> Column:
    return F.split(F.substring_index(print_, "|", -1), ";")


def _paragraphs(section: Column) -> Column:
    return F.split(F.substr(section, F.lit(NODE + 2)), ",")


def _leaves(paragraph: Column) -> Column:
    return F.regexp_extract_all(F.substr(paragraph, F.lit(NODE + 1)), F.lit(f"[0-9a-f]{{{LEAF_DIGITS}}}"), F.lit(0))


def _digits(paragraphs: Column) -> Column:
    """Digits of leaves in the paragraphs."""
    return F.aggregate(paragraphs, F.lit(0), lambda n, p: n + F.length(p) - NODE)


def likeness(a: Column, b: Column) -> Column:
    """How much of two trees is equal, from 0 to 1, by their fingerprints: 1 where the roots agree, else less.

    The trees are walked from above. Sections that both have are equal with all below; of the others
    the paragraphs are compared, and of those that only one has the leaves. Shared leaves count as a
    part of the leaves of both.
    """
    sides = lambda x: F.transform(_sections(x), lambda s: F.struct(F.left(s, F.lit(NODE)).alias("node"), _paragraphs(s).alias("paragraphs")))

    def walk(x: Column, y: Column) -> Column:
        """Digits of equal leaves and of all leaves."""
        nodes = F.array_intersect(F.transform(x, lambda s: s["node"]), F.transform(y, lambda s: s["node"]))
        own, other = (F.flatten(F.transform(F.filter(side, lambda s: ~F.array_contains(nodes, s["node"])), lambda s: s["paragraphs"])) for side in (x, y))
        whole = F.aggregate(F.concat(x, y), F.lit(0), lambda n, s: n + _digits(s["paragraphs"]))
        return _bound(F.struct(own.alias("x"), other.alias("y")), lambda r: _below(r["x"], r["y"], whole))

    def _below(x: Column, y: Column, whole: Column) -> Column:
        shared = F.array_intersect(x, y)
        left = whole - _digits(x) - _digits(y)  # in equal sections
        rest = lambda side, common: F.filter(side, lambda p: ~F.array_contains(common, p))

        def leaves(common: Column) -> Column:
            return _bound(F.struct(rest(x, common).alias("x"), rest(y, common).alias("y")), lambda r: count(r["x"], r["y"]))

        def count(u: Column, v: Column) -> Column:
            one, two = (F.flatten(F.transform(side, _leaves)) for side in (u, v))
            in_paragraphs = _digits(x) + _digits(y) - _digits(u) - _digits(v)
            equal = _bound(F.struct(one.alias("one"), two.alias("two")), lambda l: _bound(F.array_intersect(l["one"], l["two"]), lambda c: F.size(F.filter(l["one"], lambda h: F.array_contains(c, h))) + F.size(F.filter(l["two"], lambda h: F.array_contains(c, h)))))
            return F.struct((left + in_paragraphs + equal * LEAF_DIGITS).alias("equal"), whole.alias("whole"))

        return _bound(shared, leaves)

    part = _bound(F.struct(sides(a).alias("x"), sides(b).alias("y")), lambda t: walk(t["x"], t["y"]))
    dice = _bound(part, lambda p: p["equal"] / F.greatest(p["whole"], F.lit(1)).cast("double"))
    return F.when(root(a) == root(b), 1.0).otherwise(F.least(dice, F.lit(0.999999)))


def _first(x: Column, y: Column) -> Column:
    """The first place, from 0, at which two arrays differ; null where they do not."""
    return F.nullif(F.array_position(F.zip_with(x, y, lambda p, q: ~p.eqNullSafe(q)), F.lit(True)), F.lit(0)) - 1


def first_difference(a: Column, b: Column) -> Column:
    """`section.paragraph.leaf`, from 0, where the walk down the first differing branches ends; null where the roots agree."""

    def inside(x: Column, y: Column, i: Column) -> Column:
        p, q = (_paragraphs(F.coalesce(F.get(s, i), F.lit("0" * NODE + ":"))) for s in (x, y))
        return _bound(F.struct(p.alias("p"), q.alias("q"), i.alias("i")), lambda r: _bound(F.coalesce(_first(r["p"], r["q"]), F.lit(0)), lambda j: F.concat_ws(".", r["i"], j, leaf(r["p"], r["q"], j))))

    def leaf(p: Column, q: Column, j: Column) -> Column:
        one, two = (_leaves(F.coalesce(F.get(x, j), F.lit(""))) for x in (p, q))
        return F.coalesce(_first(one, two), F.lit(0))

    walk = _bound(F.struct(_sections(a).alias("x"), _sections(b).alias("y")), lambda t: _bound(F.coalesce(_first(t["x"], t["y"]), F.lit(0)), lambda i: inside(t["x"], t["y"], i)))
    return F.when(root(a) != root(b), walk)


def followed(docs: DataFrame, columns: list[str]) -> DataFrame:
    """docs with next_<column> of the next row by descending doc_id; after the last row comes the first.

    Rows are dealt to ranges of doc_id, whose bounds are quantiles, and quantiles within those where
    there are many: at most RANGES times RANGES, whose bounds are broadcast. Each range's first row
    also goes, as a guest, to the end of the range before it, so a window within each range sees every
    neighbour. Ties of doc_id go by a hash of the text; null ids come last.
    """
    at = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    (n,) = docs.agg(F.count(F.lit(1))).first()
    parts = max(1, min(n // RANGE_ROWS, RANGES * RANGES))
    levels = [parts] if parts <= RANGES else [int(parts**0.5), -(-parts // int(parts**0.5))]
    # ranges count from the largest ids
    above = lambda bounds: F.size(F.filter(bounds, lambda x: x > at))
    cuts = lambda k: F.percentile_approx(at, [i / k for i in range(1, k)], 100 * k)
    coarse = sorted(set(docs.agg(cuts(levels[0])).first()[0] or [])) if levels[0] > 1 else []  # RANGES numbers at most
    rows = docs.withColumn("_range", (above(F.array(*map(F.lit, coarse))) if coarse else F.lit(0)).cast("long"))
    if len(levels) > 1:
        fine = rows.select("doc_id", "_range").groupBy(F.col("_range").alias("_of")).agg(cuts(levels[1]).alias("_cuts"))
        rows = rows.join(F.broadcast(fine), F.col("_range") == F.col("_of"))
        rows = rows.withColumn("_range", F.col("_range") * levels[1] + above(F.array_distinct("_cuts"))).drop("_of", "_cuts")
    # a row per range: its largest id, and the range before it, for the first one the last
    tops = rows.select("doc_id", "_range").groupBy("_range").agg(F.max(at).alias("_top"))
    order, every = Window.orderBy("_range"), Window.partitionBy()
    tops = tops.select(F.col("_range").alias("_of"), "_top", F.coalesce(F.lag("_range").over(order), F.max("_range").over(every)).alias("_to"), (F.col("_range") == F.min("_range").over(every)).alias("_end"))
    rows = rows.join(F.broadcast(tops), F.col("_range") == F.col("_of"))
    home = F.struct(F.col("_range").alias("to"), F.lit(False).alias("guest"), F.lit(False).alias("end"))
    guest = F.struct(F.col("_to").alias("to"), F.lit(True).alias("guest"), F.col("_end").alias("end"))
    rows = rows.withColumn("_place", F.explode(F.when(F.col("_top") == at, F.array(home, guest)).otherwise(F.array(home)))).drop("_range", "_of", "_top", "_to", "_end")
    # the very first row is a guest at the very end, after rows with any id
    w = Window.partitionBy("_place.to").orderBy("_place.end", F.desc_nulls_last("doc_id"), F.xxhash64("text"), "_place.guest")
    rows = rows.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in columns])
    return rows.filter(~F.col("_place.guest")).drop("_place")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, how alike they are, and where the edit begins.

    A null text is empty, and its edited text is the same; equal texts have equal fingerprints. Rows
    that repeat an id are ordered by a hash of their text; equal ones follow each other. One row alone
    is its own next row. A very long text's tree is whole; its fingerprint grows with it. Other columns
    are not read.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return compared(followed(own.withColumn("fingerprint", fingerprint(F.col("text"))), ["text", "fingerprint"]))


def compared(rows: DataFrame) -> DataFrame:
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), F.concat(F.left("text", n - cut), F.left("next_text", cut)).alias("edited"), "fingerprint", "next_fingerprint")
    rows = rows.select("*", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), fingerprint(F.col("edited")).alias("edited_fingerprint"))
    near = [likeness(F.col("fingerprint"), F.col(c)).alias(name) for c, name in (("edited_fingerprint", "near_edited"), ("next_fingerprint", "near_next"))]
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", *near, first_difference(F.col("fingerprint"), F.col("edited_fingerprint")).alias("first_difference"))
