"""Left alignment of insertions and deletions against a reference sequence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.variants import minimal_alleles
from ..runtime import written


def reference_chunks(sequences: DataFrame, chunk: int = 1000) -> DataFrame:
    """(chrom, seq: a whole sequence) cut into chunks: chrom, chunk (from 0), bases."""
    places = F.sequence(F.lit(0).cast("long"), F.floor((F.length("seq") - 1) / chunk))
    cut = sequences.filter(F.length("seq") > 0).select("chrom", "seq", F.explode(places).alias("chunk"))
    return cut.select("chrom", "chunk", F.upper(F.substr(F.col("seq"), F.col("chunk").cast("int") * chunk + 1, F.lit(chunk))).alias("bases"))


def left_aligned(variants: DataFrame, chunks: DataFrame, chunk: int = 1000, chrom: str = "chrom", pos: str = "pos", ref: str = "ref", alt: str = "alt") -> DataFrame:
    """variants with norm_pos, norm_ref, norm_alt: without shared bases and as far left as the reference allows.

    A pure insertion or deletion of k bases, behind a context of the reference, moves left as long
    as the bases of context and indel are equal at distance k. The context is a variant's own chunk
    and the one before; those that could move beyond it go again from where they stand. Positions
    count from 1. Nulls, and variants on sequences that aren't there, are trimmed only.
    """
    ends = minimal_alleles(F.col(pos), F.col(ref), F.col(alt))
    made = variants.withColumn("__t", ends).select(*variants.columns, F.col("__t.pos").cast("long").alias("norm_pos"), F.col("__t.a").alias("norm_ref"), F.col("__t.b").alias("norm_alt"))
    # an indel keeps one base before it; everything else stays where it is
    indel = (F.length("norm_ref") != F.length("norm_alt")) & (F.least(F.length("norm_ref"), F.length("norm_alt")) == 1) & (F.substring("norm_ref", 1, 1) == F.substring("norm_alt", 1, 1))
    made = written(made.withColumn("__moves", F.coalesce(indel, F.lit(False))), "indels")
    done = made.filter("not __moves").drop("__moves")
    left = made.filter("__moves")
    own = chunks.select(F.col("chrom").alias("__c"), F.col("chunk").alias("__n"), F.col("bases").alias("__own"))
    before = chunks.select(F.col("chrom").alias("__bc"), (F.col("chunk") + 1).alias("__bn"), F.col("bases").alias("__before"))
    while True:
        place = F.floor((F.col("norm_pos") - 1) / chunk)
        met = left.join(own, (F.col(chrom) == F.col("__c")) & (place == F.col("__n")), "left").join(before, (F.col(chrom) == F.col("__bc")) & (place == F.col("__bn")), "left")
        met = met.withColumn("__long", F.when(F.length("norm_ref") > 1, F.substr(F.col("norm_ref"), F.lit(2))).otherwise(F.substr(F.col("norm_alt"), F.lit(2))))
        # the context ends with the base before the indel, at norm_pos
        met = met.withColumn("__context", F.concat(F.coalesce("__before", F.lit("")), F.substr(F.col("__own"), F.lit(1), ((F.col("norm_pos") - 1) % chunk + 1).cast("int"))))
        met = met.withColumn("__text", F.split(F.concat("__context", "__long"), ""))
        n, k = F.size("__text"), F.length("__long")
        equal = F.reverse(F.zip_with(F.slice("__text", F.lit(1), n - k), F.slice("__text", k + 1, n - k), lambda a, b: a == b))
        differs = F.array_position(equal, F.lit(False))  # 0 where none does
        shift = F.when(differs > 0, differs - 1).otherwise((n - k).cast("long"))
        # one base of the context must stay as the base before
        met = met.withColumn("__shift", F.coalesce(F.least(shift, F.length("__context") - 1), F.lit(0)).cast("int"))
        more = (F.col("__shift") > 0) & (F.col("__shift") == F.length("__context") - 1) & (F.col("norm_pos") - F.col("__shift") > 1)
        at = n - k - F.col("__shift")
        anchor, moved = F.element_at("__text", at), F.array_join(F.slice("__text", at + 1, k), "")
        deletion = F.length("norm_ref") > 1
        got = met.select(*variants.columns, (F.col("norm_pos") - F.col("__shift")).alias("norm_pos"), F.when(F.col("__own").isNull(), F.col("norm_ref")).when(deletion, F.concat(anchor, moved)).otherwise(anchor).alias("norm_ref"), F.when(F.col("__own").isNull(), F.col("norm_alt")).when(deletion, anchor).otherwise(F.concat(anchor, moved)).alias("norm_alt"), F.coalesce(more, F.lit(False)).alias("__moves"))
        got = written(got, "indels")
        done = done.unionByName(got.filter("not __moves").drop("__moves"))
        left = got.filter("__moves")
        if left.isEmpty():
            return done
