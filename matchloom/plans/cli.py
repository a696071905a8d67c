"""Command line: normalize, profile, block, train, score. Run with python -m matchloom.plans.cli or spark-submit."""

from __future__ import annotations

import argparse
import time

from pyspark.sql import SparkSession

from matchloom.functions.tables import RAW
from matchloom.operators import blocking, features, model, pairs, profile
from matchloom.operators.normalize import normalize
from matchloom.sources import readers, writers
from matchloom.sources.scratch import written


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="matchloom", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *required: str, **optional):
        c = sub.add_parser(name)
        for x in required:
            c.add_argument(f"--{x}", required=True)
        for x, default in optional.items():
            c.add_argument(f"--{x.replace('_', '-')}", default=default, type=type(default) if default is not None else str)

    command("normalize", "input", "source-name", "output")
    command("profile", "output", source1=None, source2=None, source3=None, ground_truth=None)
    command("block", "source1", "source2", "output", name_column="name_core", max_prefix_block_size=blocking.MAX_BLOCK)
    command("train", "source1", "source2", "source3", "ground-truth", "output", trees=300, depth=5)
    command("score", "source1", "candidate-source", "candidates", "model", "output")
    return p


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(args)
    spark = spark or SparkSession.builder.appName("matchloom").getOrCreate()
    began = time.perf_counter()
    if a.command == "normalize":
        n = writers.write_parquet(normalize(readers.read_raw(spark, a.input), a.source_name), a.output)
        took = time.perf_counter() - began
        print(f"{n} rows in {took:.1f} s ({n / took:.0f} rows/s)")
    elif a.command == "profile":
        paths = {k: v for k, v in (("source1", a.source1), ("source2", a.source2), ("source3", a.source3)) if v}
        for name, path in readers.present(spark, paths).items():
            df = readers.read_raw(spark, path)
            writers.write_text(spark, f"{a.output}/{name}.json", writers.profile_json(profile.profile_columns(df, list(RAW)), profile.domain_hint(df)))
        if a.ground_truth:
            truth = profile.profile_truth(readers.read_tsv(spark, a.ground_truth, readers.TRUTH_SCHEMA))
            writers.write_text(spark, f"{a.output}/ground_truth.json", writers.profile_json(spark.createDataFrame([], "name string"), truth))
    elif a.command == "block":
        found = blocking.generate_candidates(readers.read_parquet(spark, a.source1), readers.read_parquet(spark, a.source2), a.name_column, a.max_prefix_block_size)
        print(f"{writers.write_parquet(blocking.to_candidate_lists(found), a.output)} source-1 records with candidates")
    elif a.command == "train":
        one, two, three = (readers.read_parquet(spark, x) for x in (a.source1, a.source2, a.source3))
        labelled = written(pairs.combined_training_pairs(one, two, three, readers.read_truth(spark, a.ground_truth)), "labelled")
        rows = written(features.training_features(one, two, three, labelled), "training")
        package, predictions = model.train(rows, a.trees, a.depth)
        package.save(f"{a.output}/package", spark)
        writers.write_parquet(predictions, f"{a.output}/oof_predictions")
        model.report(predictions).show(20, False)
    else:
        package = model.Package.load(a.model, spark)
        scored = model.predict(readers.read_parquet(spark, a.source1), readers.read_parquet(spark, a.candidate_source), readers.read_candidates(spark, a.candidates), package)
        writers.write_scores(scored, a.output)
        profile.score_summary(scored).show()
        profile.head_of(scored).show(20, False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
