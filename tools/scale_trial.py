"""Copies of the conversations table with shifted keys, to see how queries scale.

    python tools/scale_trial.py SRC_DIR OUT_DIR COPIES [HOT_SHARE_PERCENT]

With a hot share, one more conversation holds that share of all rows. Time the result
with BENCH_SF_DIR=OUT_DIR python bench.py.
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from turnloom.session import local_session  # noqa: E402


def main(src: str, out: str, copies: int, hot_percent: int = 0) -> None:
    spark = local_session(8, "scale-trial")
    base = spark.read.parquet(f"{src}/conversations.parquet")
    shift = 1 + base.agg(F.max("conv_id")).first()[0]
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    rows = base.repartition(32).withColumn("copy", copy)
    rows = rows.select(
        (F.col("conv_id") + F.col("copy") * shift).alias("conv_id"), "turn", "role", "text"
    )
    if hot_percent:
        n = base.count() * copies * hot_percent // (100 - hot_percent)
        role = F.when(F.col("id") % 2 == 0, "user").otherwise("assistant")
        text = F.concat(F.lit("turn "), F.md5(F.col("id").cast("string")))
        hot = spark.range(n).select(
            F.lit(copies * shift + 2).alias("conv_id"),
            F.col("id").alias("turn"),
            role.alias("role"),
            text.alias("text"),
        )
        rows = rows.unionByName(hot)
    rows.write.parquet(f"{out}/conversations.parquet")
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{src}/{name}.parquet").write.parquet(f"{out}/{name}.parquet")
    print(spark.read.parquet(f"{out}/conversations.parquet").count(), "rows")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2], *map(int, sys.argv[3:]))
