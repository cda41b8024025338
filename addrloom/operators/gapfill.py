"""Gaps filled from similar records: a Chow-Liu dependency tree over discretised and categorical fields.

1. Numeric fields are cut into quantile bins; every other field is taken as typed, in capitals. The rows become counts of their distinct
   combinations, and these become the pair counts of every two fields: two shuffles of partly aggregated counts.
2. From the pair counts comes the mutual information of every pair (less the bias of sparse counts); the maximum spanning tree over it
   is the dependency tree. Only one number per pair of fields reaches the driver.
3. Each distinct combination of *evidence* fields among the rows with gaps sends messages through the tree; what arrives at a missing
   field is its posterior, decoded to the mode, or for a numeric field to the median of the most likely bin.
4. Where no message arrives (the path to the field runs over values never seen together) the stronger pair that links an evidence field
   directly to the missing one fills it. A filled cell must be backed directly by an evidence field: some row holds its value there
   and has the missing field. Other gaps stay.

Tables of keys are joined by broadcast only below a counted bound. Null, blank and placeholder values are gaps; an empty table gives no
rows; repeated rows count as often as they occur; other columns of the input, whatever their names, aren't read.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.tables import shared, small, spread, table
from .profile import typed

#: Least ratio of a message's probability to that of the value alone: what a value gets that a neighbour never met.
FLOOR = 1e-6
BINS = 16
_GAP = "\x01"


def plain_pin(c: Column) -> Column:
    """The six digits of a PIN written with spaces, dashes, a leading PIN or a trailing .0; else null."""
    t = F.regexp_replace(F.regexp_replace(F.upper(c), r"[\s-]", ""), r"^PIN|\.0\z", "")
    return F.when(t.rlike(r"\A[0-9]{6}\z"), t)


def discretised(rows: DataFrame, field: str, bins: int = BINS) -> tuple[Column, list[float]]:
    """The quantile bin of a numeric field, as text (null for null and NaN), and the inner edges of the bins."""
    value = F.col(field).cast("double")
    good = F.when(~F.isnan(value), value)
    edges = rows.select(F.percentile_approx(good, [i / bins for i in range(1, bins)], 10_000).alias("e")).collect()[0].e or []
    edges = sorted(set(edges))
    label = sum((F.when(good > e, 1).otherwise(0) for e in edges), F.lit(0))
    return F.when(good.isNotNull(), label.cast("string")), edges


def pair_counts(rows: DataFrame, fields: list[str], name: str) -> DataFrame:
    """(a, b, x, y, n): how often value x of field a meets value y of field b, for every two fields a before b."""
    combos = rows.groupBy(*fields).agg(F.count("*").alias("n"))
    pairs = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).alias("x"), F.col(b).alias("y")) for a, b in combinations(fields, 2)]
    out = combos.select("n", F.explode(F.array(*pairs)).alias("p")).where("p.x IS NOT NULL AND p.y IS NOT NULL")
    return shared(out.groupBy("p.a", "p.b", "p.x", "p.y").agg(F.sum("n").alias("n")), name)


def information(pairs: DataFrame) -> tuple[dict[tuple[str, str], float], dict[tuple[str, str], int]]:
    """Mutual information in nats of every two fields, less (Kxy - Kx - Ky + 1) / 2N for the cells that were seen, and the rows N."""

    def entropy(*by: str) -> DataFrame:
        g = pairs.groupBy("a", "b", *by).agg(F.sum("n").alias("n")).groupBy("a", "b")
        return g.agg(F.sum(F.col("n") * F.log("n")).alias("h"), F.count("*").alias("k"), F.sum("n").alias("n")).withColumn("of", F.lit("".join(by)))

    got: dict[tuple[str, str], dict[str, tuple[float, int, int]]] = {}
    for r in entropy("x", "y").unionAll(entropy("x")).unionAll(entropy("y")).collect():
        got.setdefault((r.a, r.b), {})[r.of] = (r.h, r.k, r.n)
    out, rows = {}, {}
    for pair, h in got.items():
        n = rows[pair] = h["xy"][2]
        mi = (h["xy"][0] - h["x"][0] - h["y"][0]) / n + math.log(n)
        out[pair] = mi - (h["xy"][1] - h["x"][1] - h["y"][1] + 1) / (2 * n)
    return out, rows


def spanning_tree(fields: list[str], mi: dict[tuple[str, str], float]) -> list[tuple[str, str]]:
    """Edges of the maximum spanning tree; a field without any pair stays alone."""
    group = {f: f for f in fields}
    tree = []
    for (a, b), _ in sorted(mi.items(), key=lambda e: (-e[1], e[0])):
        if group[a] != group[b]:
            old, new = group[a], group[b]
            group = {f: new if g == old else g for f, g in group.items()}
            tree.append((a, b))
    return tree


def conditional(pairs: DataFrame, given: str, of: str, total: int) -> DataFrame:
    """(z, v, p, base): probability p of value v of `of` where `given` is z, and of v among the `total` rows of the pair."""
    straight = (F.col("a") == given) & (F.col("b") == of)
    rows = pairs.where(straight | ((F.col("a") == of) & (F.col("b") == given)))
    rows = rows.select(F.when(straight, F.col("x")).otherwise(F.col("y")).alias("z"), F.when(straight, F.col("y")).otherwise(F.col("x")).alias("v"), "n")
    by_z = rows.groupBy("z").agg(F.sum("n").alias("zn"))
    by_v = rows.groupBy("v").agg(F.sum("n").alias("vn"))
    joined = rows.join(by_z, "z").join(by_v, "v")
    return joined.select("z", "v", (F.col("n") / F.col("zn")).alias("p"), (F.col("vn") / F.lit(max(1, total))).alias("base"))


def _either(of: dict[tuple[str, str], int], a: str, b: str) -> int:
    return of.get((a, b), of.get((b, a), 0))


class Tree:
    """Message passing from evidence to missing fields over a dependency tree."""

    def __init__(self, pairs: DataFrame, edges: list[tuple[str, str]], evidence: DataFrame, keys: list[str], totals: dict[tuple[str, str], int]):
        self.pairs, self.evidence, self.keys, self.totals = pairs, evidence, keys, totals
        self.near: dict[str, list[str]] = {}
        for a, b in edges:
            self.near.setdefault(a, []).append(b)
            self.near.setdefault(b, []).append(a)

    def message(self, source: str, to: str) -> DataFrame | None:
        """(eid, v, p, base): probability of the values of `to` as seen from the side of `source`."""
        belief = self.belief(source, to)
        if belief is None:
            return None
        met = belief.select("eid", F.col("v").alias("z"), "w").join(conditional(self.pairs, source, to, _either(self.totals, source, to)), "z")
        return met.groupBy("eid", "v").agg(F.sum(F.col("w") * F.col("p")).alias("p"), F.max("base").alias("base"))

    def belief(self, field: str, without: str | None = None) -> DataFrame | None:
        """(eid, v, w): weights of the values of `field`, summing to 1 for each eid that any evidence reaches."""
        known = None
        if field in self.keys and without is not None:  # as a source: observed values count as they are
            known = self.evidence.where(F.col(field).isNotNull()).select("eid", F.col(field).alias("v"), F.lit(1.0).alias("w"))
        messages = [m for n in self.near.get(field, []) if n != without and (m := self.message(n, field)) is not None]
        if not messages:
            return known
        ratio = F.log(F.col("p") / F.col("base")) - F.log(F.lit(FLOOR))
        every = messages[0]
        for m in messages[1:]:
            every = every.unionAll(m)
        score = every.groupBy("eid", "v").agg((F.sum(ratio) + F.log(F.max("base"))).alias("s"))
        of = Window.partitionBy("eid")
        score = score.withColumn("w", F.exp(F.col("s") - F.max("s").over(of)))
        score = score.select("eid", "v", (F.col("w") / F.sum("w").over(of)).alias("w"))
        if known is not None:
            score = score.join(known.select("eid"), "eid", "left_anti").unionAll(known)
        return score


def filled(rows: DataFrame, row_id: str, fields: list[str], keys: list[str], edges: list[tuple[str, str]], pairs: DataFrame, mi: dict[tuple[str, str], float], totals: dict[tuple[str, str], int], usable: dict[str, Column] | None = None, prefer: dict[str, Column] | None = None) -> DataFrame:
    """(row_id, field_name, value, filled_by, probability) of every gap of `fields` in `rows`; value and filled_by null where it stays.

    `keys` are the evidence fields; `usable` gives the form in which a key may serve as evidence; of values equally backed those with a
    true `prefer` (a column over v) come first. filled_by is tree or the name of the key that fills directly."""
    usable, prefer = usable or {}, prefer or {}
    targets = list(fields)
    sign = F.concat_ws(_GAP, *[F.coalesce(usable.get(k, F.col(k)), F.lit("")) for k in keys])
    gaps = rows.where(" OR ".join(f"`{f}` IS NULL" for f in targets)).withColumn("eid", sign)
    evidence = gaps.select("eid", *[usable.get(k, F.col(k)).alias(k) for k in keys]).distinct().where(" OR ".join(f"`{k}` IS NOT NULL" for k in keys))
    evidence = shared(evidence, "p2-evidence")
    tree = Tree(pairs, edges, evidence, keys, totals)
    answers = evidence
    for f in targets:
        first = prefer.get(f, F.lit(True))
        found = tree.belief(f)
        if found is not None:
            best = found.groupBy("eid").agg(F.max_by(F.struct("v", "w"), F.struct(first, "w", "v")).alias(f"{f}__tree"))
            answers = answers.join(small(shared(best, f"p2-{f}")), "eid", "left")
        direct = sorted((k for k in keys if k != f), key=lambda k: (-mi.get((k, f), mi.get((f, k), -1.0)), k))
        value, by = [], []
        for k in direct:
            mode = conditional(pairs, k, f, _either(totals, k, f)).groupBy("z").agg(F.max_by(F.struct("v", F.col("p").alias("w")), F.struct(first, "p", "v")).alias(f"{f}__{k}"))
            answers = answers.join(small(mode.withColumnRenamed("z", k)), k, "left")
            value.append(F.col(f"{f}__{k}"))
            by.append(F.when(F.col(f"{f}__{k}").isNotNull(), F.lit(k)))
        if not direct:  # the only evidence field has none to be filled by
            answers = answers.withColumn(f"{f}__out", F.lit(None).cast("struct<value:string,filled_by:string,probability:double>"))
            continue
        backed = F.coalesce(*[v["v"] for v in value]).isNotNull()
        if found is not None:
            value, by = [F.col(f"{f}__tree"), *value], [F.when(F.col(f"{f}__tree").isNotNull(), F.lit("tree")), *by]
        chosen = F.coalesce(*value)
        answers = answers.withColumn(f"{f}__out", F.when(backed, F.struct(chosen["v"].alias("value"), F.coalesce(*by).alias("filled_by"), chosen["w"].alias("probability"))))
    answers = shared(answers.select("eid", *[f"{f}__out" for f in targets]), "p2-answers")
    cells = F.array(*[F.when(F.col(f).isNull(), F.struct(F.lit(f).alias("field_name"), F.col(f"{f}__out").alias("o"))) for f in targets])
    out = gaps.join(small(answers), "eid", "left").select(row_id, F.explode(F.array_compact(cells)).alias("x"))
    return out.select(row_id, "x.field_name", "x.o.value", "x.o.filled_by", "x.o.probability")


def impute(df: DataFrame, row_id: str, categorical: list[str], numeric: list[str], keys: list[str]) -> DataFrame:
    """Every gap of the fields of `df` with the value that fills it, as `filled`; numeric values come back as the text of a median.

    Fields in `keys` are evidence and are filled themselves from the other keys; the rest are filled only."""
    fields = [*categorical, *numeric]
    labels = {f: typed(F.col(f).cast("string")).alias(f) for f in categorical}
    for f in numeric:
        label, _ = discretised(df, f)
        labels[f] = label.alias(f)
    rows = df.select(row_id, *[labels[f] for f in fields])
    pairs = pair_counts(rows, fields, "fill-pairs")
    mi, totals = information(pairs)
    out = filled(rows, row_id, fields, keys, spanning_tree(fields, mi), pairs, mi, totals)
    for f in numeric:
        label, _ = discretised(df, f)
        medians = df.select(label.alias("bin"), F.col(f).cast("double").alias("x")).where("bin IS NOT NULL").groupBy("bin").agg(F.percentile_approx("x", 0.5, 10_000).alias("m"))
        out = out.join(F.broadcast(medians), (out["field_name"] == f) & (out["value"] == medians["bin"]), "left")  # BINS rows
        out = out.withColumn("value", F.when(F.col("field_name") == f, F.col("m").cast("string")).otherwise(F.col("value"))).drop("bin", "m")
    return out


FIELDS = ["city", "state", "pincode", "post_office"]


def p2_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every missing city, state and pincode with the value that fills it, how and how surely; null where the gap stays.

    A PIN is compared as its six digits and serves as evidence only if it has them; the post office serves as it is typed."""
    own = spread(table(spark, sf_dir, "cleaned_address_data").select("row_id", *FIELDS))
    pin = plain_pin(F.col("pincode"))
    rows = own.select("row_id", typed(F.col("city")).alias("city"), typed(F.col("state")).alias("state"), F.coalesce(F.when(typed(F.col("pincode")).isNotNull(), pin), typed(F.col("pincode"))).alias("pincode"), typed(F.col("post_office")).alias("post_office"))
    rows = shared(rows, "p2-rows")
    pairs = pair_counts(rows, FIELDS, "p2-pairs")
    mi, totals = information(pairs)
    wellformed = F.col("v").rlike(r"\A[1-9][0-9]{5}\z")
    usable = {"pincode": F.when(F.col("pincode").rlike(r"\A[0-9]{6}\z"), F.col("pincode"))}
    return filled(rows, "row_id", ["city", "state", "pincode"], ["pincode", "post_office"], spanning_tree(FIELDS, mi), pairs, mi, totals, usable, {"pincode": wellformed})


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The missing cells that the tree, or a pair of fields directly, fills from records of the same PIN or post office."""
    return p2_filled(spark, sf_dir).where("value IS NOT NULL").select("row_id", "field_name")


FOUND_SQL = r"""
WITH r AS (
  SELECT row_id, c.city, c.state, c.pincode, c.post_office, CASE WHEN regexp_full_match(p, '[0-9]{6}') AND c.pincode IS NOT NULL THEN p END pin FROM (
    SELECT row_id, {city} city, {state} state, {pincode} pincode, {post_office} post_office,
      regexp_replace(regexp_replace(upper(pincode), '[\s-]', '', 'g'), '^PIN|\.0$', '', 'g') p FROM cleaned_address_data) c),
p AS (SELECT pin k, bool_or(city IS NOT NULL) city, bool_or(state IS NOT NULL) state FROM r WHERE pin IS NOT NULL GROUP BY 1),
o AS (SELECT post_office k, bool_or(city IS NOT NULL) city, bool_or(state IS NOT NULL) state, bool_or(pincode IS NOT NULL) pincode FROM r WHERE post_office IS NOT NULL GROUP BY 1)
SELECT row_id, 'city' field_name FROM r LEFT JOIN p ON pin = p.k LEFT JOIN o ON post_office = o.k WHERE r.city IS NULL AND (p.city OR o.city)
UNION ALL SELECT row_id, 'state' FROM r LEFT JOIN p ON pin = p.k LEFT JOIN o ON post_office = o.k WHERE r.state IS NULL AND (p.state OR o.state)
UNION ALL SELECT row_id, 'pincode' FROM r LEFT JOIN o ON post_office = o.k WHERE r.pincode IS NULL AND o.pincode
"""
_TYPED = "CASE WHEN upper(trim({c}, e' \\t\\n\\r')) NOT IN ('','NA','N/A','NAN','NULL','NONE','NIL','-','--','0','NOT AVAILABLE','UNKNOWN') THEN upper(trim({c}, e' \\t\\n\\r')) END"
QUERIES = {"p2_found": p2_found, "p2_filled": p2_filled}
SQL = {"p2_found": FOUND_SQL.replace("{6}", "{{6}}").format(**{c: _TYPED.format(c=c) for c in FIELDS})}
