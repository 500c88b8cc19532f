"""Capping the records of dominant contributors by radix selection.

Score and identifier become order-preserving bytes, four and as many as the identifiers need.  For each
contributor above the limit the cutoff is found one byte at a time: count the contributor's candidates by
their next byte and take the byte in which the limit falls.  Records before it stay, those behind it go by
that comparison, and only those that share it, the cutoff's prefix so far, are read again for the next byte.
Nothing is sorted, and no contributor's rows ever meet in one task: counts combine on the map side, and a
contributor has at most 256 of them a byte.  Cutoffs are tables, broadcast only where few.

Defined results:

* Higher scores stay; null and NaN scores rank last; -0.0 equals 0.0; among equal scores the smaller
  identifier stays.
* Records without a contributor (null or blank login) have no limit and always stay.
* A record whose identifier is null ranks behind all others with its score.
* Repeated rows each count.  An empty table gives no rows.  Extra columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hunkmill import workspace
from hunkmill.llm import spellings
from hunkmill.operators.deliveries import instant_us, preference

SCORE_BYTES = 4


def descending_code(score: Column) -> Column:
    """A number below 2^32 that is smaller the higher the float ``score`` is; null and NaN come last.

    IEEE 754 bits compare like integers once negative numbers are flipped.
    """
    bits = _float_bits(score)
    rising = F.when(bits < 2**31, bits + 2**31).otherwise(2**32 - 1 - bits)
    return F.when(score.isNull() | F.isnan(score), F.lit(2**32 - 1)).otherwise(F.lit(2**32 - 2) - rising)


def _float_bits(score: Column) -> Column:
    """The four bytes of a float, by arithmetic: sign, exponent and mantissa."""
    size = F.abs(score).cast("double")
    x = F.when(size < float("inf"), size)  # neither null, NaN nor infinite
    e = F.greatest(F.floor(F.log2(F.when(x > 0, x))), F.lit(-126))
    # log2 may be off by one at powers of two
    e = F.when(x >= F.pow(F.lit(2.0), e + 1), e + 1).when((x < F.pow(F.lit(2.0), e)) & (e > -126), e - 1).otherwise(e)
    frac = x / F.pow(F.lit(2.0), e)
    normal = frac >= 1
    mantissa = F.round((frac - F.when(normal, 1.0).otherwise(0.0)) * 2**23).cast("bigint")
    exponent = F.when(normal, (e + 127).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    plain = F.when(size == 0, F.lit(0)).when(size == float("inf"), F.lit(255 << 23)).otherwise(exponent * 2**23 + mantissa)
    return plain + F.when(score < 0, F.lit(2**31)).otherwise(F.lit(0))


#: Contributors whose cutoffs may be broadcast: a name and two numbers each.
BROADCAST_CUTOFFS = 100_000


def _few(rows: DataFrame) -> DataFrame:
    """Marked for broadcast if its counted rows are few enough; else as it is."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_CUTOFFS else rows


def beyond_cap(records: DataFrame, limit: int, who: str, score: str, ident: str) -> DataFrame:
    """The ``ident`` of every record beyond the ``limit`` best of its contributor.

    Only contributors above the limit enter the selection, however many they are.  After each byte the rows that
    are still undecided are written; they are those that share the bytes fixed so far.
    """
    slim = records.select(F.col(who).alias("who"), F.col(ident).alias("ident"), F.col(score).cast("float").alias("score"))
    slim = slim.where(F.col("who").isNotNull())
    empty = records.select(ident).where(F.lit(False))
    heavy = workspace.keep(slim.groupBy("who").agg(F.count("*").alias("n")).where(F.col("n") > limit).select("who"), "heavy")
    if heavy.isEmpty():
        return empty
    span = slim.agg(F.min("ident").alias("lo"), F.max("ident").alias("hi")).first()
    base, top = (span.lo, span.hi) if span.lo is not None else (0, 0)
    # one past the largest stands for a null identifier
    id_bytes = max(1, -(-((top - base + 1).bit_length()) // 8))
    place = F.coalesce(F.col("ident") - base, F.lit(top - base + 1)).alias("place")
    live = workspace.keep(slim.join(_few(heavy), "who", "left_semi").select("who", "ident", descending_code(F.col("score")).alias("code"), place), "live")
    free = heavy.select("who", F.lit(limit).cast("bigint").alias("free"))
    gone = empty.select(F.col(ident).alias("ident"))
    digits = [("code", k) for k in reversed(range(SCORE_BYTES))] + [("place", k) for k in reversed(range(id_bytes))]
    for column, k in digits:
        digit = F.shiftright(column, 8 * k).bitwiseAND(F.lit(255))
        counts = live.groupBy("who", digit.alias("digit")).agg(F.count("*").alias("n"))
        upto = F.sum("n").over(W.partitionBy("who").orderBy("digit").rowsBetween(W.unboundedPreceding, 0))  # 256 rows at most
        here = counts.join(_few(free), "who").withColumn("upto", upto).where((F.col("upto") > F.col("free")) & (F.col("upto") - F.col("n") <= F.col("free")))
        cut = workspace.keep(here.select("who", F.col("digit").alias("cut"), (F.col("free") - F.col("upto") + F.col("n")).alias("left")), "cut")
        met = live.join(_few(cut), "who").withColumn("digit", digit)
        behind = (F.col("digit") > F.col("cut")) | ((F.col("digit") == F.col("cut")) & (F.col("left") == 0))
        gone = gone.unionByName(met.where(behind).select("ident"))
        live = workspace.keep(met.where((F.col("digit") == F.col("cut")) & (F.col("left") > 0)).select("who", "ident", "code", "place"), "live")
        free = cut.where("left > 0").select("who", F.col("left").alias("free"))
        if free.isEmpty():
            return gone.withColumnRenamed("ident", ident)
    # rows left here are equal in score and identifier: repeated rows, of which any may stay
    same = live.join(_few(free), "who").groupBy("who", "ident", "free").agg(F.count("*").alias("n"))
    extra = same.select("ident", F.explode(F.sequence(F.lit(1), (F.col("n") - F.col("free")).cast("int"))).alias("k")).select("ident")
    return gone.unionByName(extra).withColumnRenamed("ident", ident)


def contributors(records: DataFrame, comments: DataFrame) -> DataFrame:
    """(record_id, score, who): each chat record with the account of its source comment.

    The comment is the delivery that the ledger's rule keeps.  Comments and records meet on the
    comment's identifier, which is unique on one side.
    """
    best = preference(instant_us(F.col("updated_at")), F.col("delivery_id"))
    kept = comments.where("id is not null").groupBy("id").agg(F.max_by(F.struct(F.col("user.login").alias("name")), best).alias("k"))
    source = kept.select(F.col("id").alias("source_id"), spellings.login(F.col("k.name")).alias("who"))
    slim = records.select("record_id", F.col("meta.source_id").alias("source_id"), F.col("meta.design_score").alias("score"))
    return slim.join(source, "source_id", "left").select("record_id", "score", "who")


def share_limit(rows: int, per_mille: int) -> int:
    """floor(rows x per_mille / 1000), at least 1."""
    return max(1, rows * per_mille // 1000)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(record_id) of the chat records that must go."""
    records = workspace.load(spark, sf_dir, "chat_records")
    settings = workspace.load(spark, sf_dir, "curation_settings").where("setting = 'contributor_max_share'")
    owned = workspace.keep(contributors(records, workspace.load(spark, sf_dir, "review_comments")), "owned")
    limit = share_limit(owned.count(), settings.first().per_mille)
    return beyond_cap(owned, limit, "who", "score", "record_id")


P2_SQL = r"""
with kept as (
  select id, user.login as name from review_comments
  qualify row_number() over (partition by id order by cast(updated_at as timestamptz) desc nulls last, delivery_id) = 1),
named as (
  select id, nullif(lower(regexp_replace(regexp_replace(name, '[\s\x{00a0}\x{200b}-\x{200f}\x{2060}\x{feff}]', '', 'g'), '^@+', '')), '') as who
  from kept),
ranked as (
  select record_id, who, row_number() over (partition by who order by meta.design_score desc nulls last, record_id) as place
  from chat_records join named on id = meta.source_id where who is not null)
select record_id from ranked
where place > greatest(1, (select count(*) from chat_records)
  * (select per_mille from curation_settings where setting = 'contributor_max_share') // 1000)
"""
