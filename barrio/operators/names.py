"""P8, J-1, J-2, Q4: repair of area names before they are joined.

A spelling difference must not become a silent zero.  Each distinct name is
matched to a known one, in three steps of falling certainty:

    exact     equal after trimming and lower-casing (the join key of P8)
    folded    equal without accents as well
    edited    the known name with the fewest edits (of equals the smallest by
              code point), at most one edit for every four letters and three
              in all

Edit candidates come from shared q-grams.  k edits destroy at most q * k of a
name's q-grams, so any q * k + 1 of them hold one that a name within k edits
still has: only the q * k + 1 rarest ones of a name are looked up.  A frequent
q-gram ("_1", "the") thus brings no crowd of candidates, and no pair within
the limit is missed.  Names are compared once each, however many rows have
them; what stays unmatched is reported, not dropped.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barrio.functions.keys import norm_key

Q = 2
MOST_EDITS, LETTERS_PER_EDIT = 3, 4
_PAD = "\u0001"


def _accents() -> tuple[str, str]:
    """Latin letters that are a plain letter with marks, and those letters."""
    pairs = [(c, unicodedata.normalize("NFKD", c)) for c in map(chr, range(0xC0, 0x180))]
    pairs = [(c, d[0]) for c, d in pairs if d[0].isascii() and d[0].isalpha()
             and all(unicodedata.combining(x) for x in d[1:]) and c.islower()]
    return "".join(c for c, _ in pairs), "".join(d for _, d in pairs)


def fold(name: Column | str) -> Column:
    """The join key of a name without accents."""
    return F.translate(norm_key(name), *_accents())


def _grams(names: DataFrame, key: str) -> DataFrame:
    """(key, gram): the q-grams of the padded name; repeats are numbered."""
    padded = F.concat(F.lit(_PAD * (Q - 1)), F.col(key), F.lit(_PAD * (Q - 1)))
    grams = F.transform(F.sequence(F.lit(1), F.length(padded) - Q + 1), lambda i: F.substr(padded, i, F.lit(Q)))
    each = names.select(key, F.posexplode(grams).alias("at", "gram"))
    nth = F.row_number().over(Window.partitionBy(key, "gram").orderBy("at"))
    return each.select(key, F.concat_ws("#", "gram", nth).alias("gram"))


def allowed_edits(key: Column) -> Column:
    return F.least(F.lit(MOST_EDITS), F.floor(F.length(key) / LETTERS_PER_EDIT)).cast("int")


def matches(names: DataFrame, known: DataFrame, name: str = "name", known_name: str = "name") -> DataFrame:
    """name, area, how (exact, folded, edited, unmatched), edits, n_best of each
    distinct name.  ``n_best`` tells how many known names are as near."""
    found = names.select(F.col(name).alias("name")).distinct().withColumn("key", norm_key("name")).withColumn(
        "fold", fold("name"))
    # of known names with one key the smallest stands for all
    areas = known.select(F.col(known_name).alias("area")).where(F.col("area").isNotNull()).distinct()
    by_key = areas.groupBy(norm_key("area").alias("key")).agg(F.min("area").alias("exact"))
    by_fold = areas.groupBy(fold("area").alias("fold")).agg(
        F.min("area").alias("folded"), F.count_distinct(norm_key("area")).alias("n_folded"))
    at_once = found.join(by_key, "key", "left").join(by_fold, "fold", "left").checkpoint(eager=True)

    open_ = at_once.where("folded IS NULL AND fold <> ''").select("fold").distinct().withColumn(
        "k", allowed_edits(F.col("fold"))).where("k > 0")
    theirs = _grams(by_fold.select(F.col("fold").alias("known")), "known")
    often = theirs.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = F.row_number().over(Window.partitionBy("fold").orderBy(F.coalesce("n", F.lit(0)), "gram"))
    mine = (_grams(open_, "fold").join(often, "gram", "left").withColumn("nth", rarest)
            .join(open_, "fold").where(F.col("nth") <= Q * F.col("k") + 1).select("fold", "k", "gram"))
    near = (mine.join(theirs, "gram").select("fold", "k", "known").distinct()
            .where(F.abs(F.length("fold") - F.length("known")) <= F.col("k"))
            .withColumn("edits", F.levenshtein("fold", "known")).where("edits <= k")
            .join(by_fold.withColumnRenamed("fold", "known"), "known"))
    best = near.groupBy("fold").agg(F.min(F.struct("edits", "folded")).alias("best"),
                                    F.collect_list("edits").alias("all"))
    best = best.select("fold", F.col("best.edits").alias("edits"), F.col("best.folded").alias("edited"),
                       F.size(F.filter("all", lambda e: e == F.col("best.edits"))).alias("n_edited"))
    out = at_once.join(best, "fold", "left")
    how = (F.when(F.col("exact").isNotNull(), "exact").when(F.col("folded").isNotNull(), "folded")
           .when(F.col("edited").isNotNull(), "edited").otherwise("unmatched"))
    return out.select(
        "name", F.coalesce("exact", "folded", "edited").alias("area"), how.alias("how"),
        F.when(F.col("folded").isNull(), F.col("edits")).otherwise(0).alias("edits"),
        F.when(F.col("exact").isNotNull(), 1).when(F.col("folded").isNotNull(), F.col("n_folded"))
        .otherwise(F.coalesce("n_edited", F.lit(0))).cast("int").alias("n_best"))


def repaired(rows: DataFrame, known: DataFrame, column: str = "neighborhood_name", known_name: str = "name"
             ) -> tuple[DataFrame, DataFrame]:
    """(rows, report): ``column`` replaced by the known name where one is found,
    else null; and the matches with the number of rows of each name."""
    found = matches(rows, known, column, known_name).checkpoint(eager=True)
    counts = rows.groupBy(F.col(column).alias("name")).agg(F.count(F.lit(1)).alias("rows"))
    report = found.alias("f").join(counts.alias("c"), F.expr("f.name <=> c.name")).select("f.*", "c.rows")
    joined = rows.alias("r").join(found.select(F.col("name").alias("_name"), F.col("area").alias("_area")).alias("f"),
                                  F.col(f"r.{column}").eqNullSafe(F.col("f._name")), "left")
    out = joined.select(*[F.col("f._area").alias(c) if c == column else F.col(f"r.`{c}`") for c in rows.columns])
    return out, report
