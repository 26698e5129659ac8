"""Order MinHash of whole texts in SQL functions, and the likeness of two fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwork.llm.common import query, table

#: Longest token in characters; longer runs are cut, so that texts without spaces are fingerprinted too.
TOKEN = 12


def with_fingerprint(df: DataFrame, text: Column, out: str, k: int = 3, places: int = 64, pick: int = 2) -> DataFrame:
    """Adds an Order MinHash fingerprint of `text`; no shuffle, and work that grows with n log n of a text's tokens.

    k-mers of k consecutive tokens (runs without white space, cut at TOKEN characters; fewer tokens make one k-mer)
    get their occurrence number in the text. One hash of (k-mer, number) deals them to `places` and orders them there;
    each place keeps its `pick` smallest, puts them back into text order and hashes that tuple. So one pass serves all
    places. The result is 8 hex digits per place, dashes where a place is empty; null and empty texts have only those.
    """
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"\S{1,%d}" % TOKEN), F.lit(0))
    steps = [
        ("_t", tokens),
        ("_n", F.expr(f"if(size(_t) = 0, 0, greatest(size(_t) - {k - 1}, 1))")),
        (
            "_g",
            F.expr(
                "if(_n = 0, array(), sort_array(transform(sequence(0, _n - 1), i -> struct("
                + "xxhash64(" + ", ".join(f"get(_t, i + {j})" for j in range(k)) + ") AS h, i AS p))))"
            ),
        ),
        ("_r", F.expr("if(_n = 0, array(), filter(sequence(0, _n - 1), i -> i = 0 OR _g[i].h <> _g[i - 1].h))")),
        (
            "_v",
            F.expr(
                "sort_array(flatten(transform(_r, (s, j) -> transform(sequence(s, coalesce(get(_r, j + 1), _n) - 1),"
                " i -> named_struct('b', pmod(xxhash64(_g[i].h, i - s), CAST(%d AS BIGINT)), 'h', xxhash64(i - s, _g[i].h),"
                " 'g', _g[i].h, 'p', _g[i].p)))))" % places
            ),
        ),
        ("_q", F.expr("if(_n = 0, array(), filter(sequence(0, _n - 1), i -> i = 0 OR _v[i].b <> _v[i - 1].b))")),
        (
            "_m",
            F.expr(
                "map_from_entries(transform(_q, (s, j) -> struct(_v[s].b, substr(lower(hex(xxhash64("
                "transform(sort_array(transform(slice(_v, s + 1, least(%d, coalesce(get(_q, j + 1), _n) - s)),"
                " e -> struct(e.p, e.g))), e -> e.g)))), -8))))" % pick
            ),
        ),
        (out, F.expr("array_join(transform(sequence(0L, %dL), b -> lpad(coalesce(_m[b], '-'), 8, if(_m[b] is null, '-', '0'))), '')" % (places - 1))),
    ]
    for name, column in steps:
        df = df.withColumn(name, column)
    return df.drop(*(name for name, _ in steps[:-1]))


def likeness(a: Column, b: Column, places: int = 64) -> Column:
    """Share of equal places among those that are filled in either; 1 for two empty fingerprints, 0 to 1."""
    empty = F.lit("-" * 8)

    def cell(x, i):
        return F.substring(x, i * 8 + 1, 8)

    filled = sum(F.when((cell(a, i) != empty) | (cell(b, i) != empty), 1).otherwise(0) for i in range(places))
    same = sum(F.when((cell(a, i) != empty) & (cell(a, i) == cell(b, i)), 1).otherwise(0) for i in range(places))
    return F.when(filled == 0, F.lit(1.0)).otherwise(same / filled)


def with_next(
    df: DataFrame, key: str, carried: list[str], rows_per_part: int = 2000, most_parts: int = 1024, prepare=None
) -> DataFrame:
    """Adds `next`, a struct of `carried` of the following row by descending key; after the last comes the first.

    Rows are cut at quantiles of the key into parts that are ordered apart. The first row of each part is also put
    at the end of the part before it, so no part depends on another: one shuffle, and at most `most_parts` rows twice.
    Ties on the key follow the carried columns. `prepare` may add columns to all rows just before they are dealt;
    `next` holds them too. A null key comes last. A single row is followed by itself.
    """
    count = df.count()
    if count == 0:
        df = prepare(df) if prepare is not None else df
        return df.withColumn("next", F.struct(*df.columns))
    parts = max(1, min(most_parts, -(-count // rows_per_part)))
    cuts = df.agg(F.percentile_approx(key, [i / parts for i in range(1, parts)] or [0.5], 100 * parts)).first()[0] or []
    cuts = sorted(set(cuts))  # at most most_parts numbers
    order = [F.col(key).desc_nulls_last(), *carried]
    above = F.lit(0)
    if cuts:
        above = F.when(F.col(key).isNull(), 0).otherwise(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col(key))))
    dealt = df.withColumn("_part", above.cast("int"))
    tops = dealt.groupBy("_part").agg(F.max(key).alias("_top")).collect()  # one row per part
    present = sorted(r["_part"] for r in tops)
    before = {p: present[(i + 1) % len(present)] for i, p in enumerate(present)}  # descending: the higher part comes first
    heads = [(r["_part"], before[r["_part"]], r["_top"]) for r in tops]
    spark = df.sparkSession
    heads = spark.createDataFrame(heads, f"_part int, _to int, _top {dict(df.dtypes)[key]}")
    ties = W.partitionBy("_part").orderBy(*carried)
    first = dealt.join(F.broadcast(heads), (dealt["_part"] == heads["_part"]) & dealt[key].eqNullSafe(heads["_top"]))
    first = first.select(*(dealt[c] for c in df.columns), F.col("_to").alias("_part"))
    first = first.withColumn("_i", F.row_number().over(ties)).filter("_i = 1").drop("_i")
    both = dealt.withColumn("_copy", F.lit(0)).unionByName(first.withColumn("_copy", F.lit(1)))
    ordered, told = W.partitionBy("_part").orderBy("_copy", *order), list(carried)
    if prepare is not None:
        ready = prepare(both)
        told += [c for c in ready.columns if c not in both.columns]
        both = ready
    return both.withColumn("next", F.lead(F.struct(*told)).over(ordered)).filter("_copy = 0").drop("_copy", "_part")


@query("op2_order_minhash")
def op2_order_minhash(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    chained = with_next(docs, "doc_id", ["text"], prepare=lambda rows: with_fingerprint(rows, F.col("text"), "fingerprint"))
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.char_length("text") - half), F.substring(F.col("next.text"), F.lit(1), half)
    )
    rows = chained.withColumn("edited", edited)
    rows = with_fingerprint(rows, F.col("edited"), "edited_fingerprint")
    return rows.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next.fingerprint")).alias("near_next"),
    )
