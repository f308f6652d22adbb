"""Command line: the two scheduled steps.

    spark-submit reviewloom/plans/jobs.py bronze-to-silver SOURCE TARGET
    spark-submit reviewloom/plans/jobs.py silver-to-gold SOURCE TARGET
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from reviewloom.plans.layers import bronze_to_silver, silver_to_gold
from reviewloom.sources.schema import CORRUPT_PRODUCT_IDS


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Review curation jobs")
    parser.add_argument("step", choices=["bronze-to-silver", "silver-to-gold"])
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument("--known-corrupt", action="store_true",
                        help="quarantine the known corrupt products (bronze-to-silver)")
    parser.add_argument("--corrupt-keys", metavar="PATH",
                        help="quarantine the products in this Parquet table (product_id)")
    parser.add_argument("--corrupt-aside", action="store_true",
                        help="set rows that do not parse aside, with the reason")
    parser.add_argument("--salts", type=int, default=1,
                        help="reducers over which each product of --corrupt-keys is spread")
    parser.add_argument("--format", default="csv", help="gold format (silver-to-gold)")
    parser.add_argument("--file-bytes", type=int, metavar="N",
                        help="size of the files of the published table (silver-to-gold)")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"reviewloom {args.step}").getOrCreate()
    if args.step == "bronze-to-silver":
        ids = CORRUPT_PRODUCT_IDS if args.known_corrupt else []
        if args.corrupt_keys:
            known = spark.createDataFrame([(i,) for i in ids], "product_id string")
            ids = spark.read.parquet(args.corrupt_keys).select("product_id").union(known)
        null_key = "drop" if args.known_corrupt or args.corrupt_keys else "keep"
        counts = bronze_to_silver(
            spark, args.source, args.target, ids, null_key, args.corrupt_aside, salts=args.salts
        )
        print(", ".join(f"{name}: {count}" for name, count in counts.items()))
    else:
        silver_to_gold(
            spark, args.source, args.target, args.format, file_bytes=args.file_bytes
        )


if __name__ == "__main__":
    main()
