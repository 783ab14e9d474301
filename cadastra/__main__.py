"""python -m cadastra list | run NAME --data DIR [--out DIR --write]: without --write nothing is written, counts are printed."""

import argparse


def main() -> None:
    p = argparse.ArgumentParser(prog="cadastra")
    sub = p.add_subparsers(dest="verb", required=True)
    sub.add_parser("list")
    run = sub.add_parser("run")
    run.add_argument("name")
    run.add_argument("--data", required=True)
    run.add_argument("--out")
    run.add_argument("--write", action="store_true")
    a = p.parse_args()
    from cadastra.plans import catalogue
    from cadastra.runtime import forget

    queries = catalogue.queries()
    if a.verb == "list":
        print("\n".join(queries))
        return
    if a.name not in queries:
        p.error(f"no query {a.name!r}")
    if a.write and not a.out:
        p.error("--write needs --out")
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("cadastra").getOrCreate()
    df = queries[a.name](spark, a.data)
    if a.write:
        df.write.mode("overwrite").parquet(a.out)
    else:
        df.printSchema()
        print(df.count(), "rows; nothing written")
    forget(spark)


if __name__ == "__main__":
    main()
