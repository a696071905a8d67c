import json

from matchloom.plans import cli
from matchloom.sources import readers, writers
from matchloom.streaming import entities as stream

TSV = 'entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"say ""hi"" Inc"\t\tNA\nS1-2\tnull\t"two\nlines"\tUS\n'


def test_tsv(spark, tmp_path):
    path = tmp_path / "a.tsv"
    path.write_text(TSV)
    rows = [tuple(r) for r in readers.read_raw(spark, str(path)).orderBy("entity_id").collect()]
    assert rows == [("S1-1", 'say "hi" Inc', "", "NA"), ("S1-2", "null", "two\nlines", "US")]
    rows = [tuple(r) for r in readers.read_tsv(spark, str(path), infer_missing=True).orderBy("entity_id").collect()]
    assert rows == [("S1-1", 'say "hi" Inc', None, None), ("S1-2", None, "two\nlines", "US")]
    assert readers.read_raw(spark, str(path), limit=1).count() == 1
    assert list(readers.present(spark, {"a": str(path), "b": str(tmp_path / "none")})) == ["a"]


def test_candidates_and_scores(spark, tmp_path):
    df = spark.createDataFrame([("S1-1", "S2-1,S2-2")], "source1_entity_id string, candidate_entity_ids string")
    assert writers.write_parquet(df, str(tmp_path / "c.PARQUET")) == 1
    assert readers.read_candidates(spark, str(tmp_path / "c.PARQUET")).count() == 2
    (tmp_path / "c.tsv").write_text("source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1, ,S2-2\n")
    found = readers.read_candidates(spark, str(tmp_path / "c.tsv"))
    assert found.count() == 2
    scores = found.selectExpr("*", "0.5D as calibrated_score")
    writers.write_scores(scores, str(tmp_path / "scores"))
    again = spark.read.csv(str(tmp_path / "scores"), sep="\t", header=True)
    assert again.columns == ["source1_entity_id", "candidate_entity_id", "calibrated_score"] and again.count() == 2


def test_command_line(spark, tmp_path):
    make = lambda p, rows: p.write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "".join("\t".join(r) + "\n" for r in rows))
    names = ["alpha stores", "beta foods", "gamma works", "delta traders", "omega mills", "sigma labs"]
    for k in (1, 2, 3):
        make(tmp_path / f"s{k}.tsv", [(f"S{k}-{i}", names[i % 6] + (f" {i} Inc" if i < 6 else f" {i} llc"), f"{i} Main St", "US") for i in range(24)])
    (tmp_path / "gt.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "".join(f"S1-{i}\tS2-{i},S3-{i}\n" for i in range(24)))
    run = lambda *a: cli.main([str(x) for x in a], spark)
    for k in (1, 2, 3):
        run("normalize", "--input", tmp_path / f"s{k}.tsv", "--source-name", f"S{k}", "--output", tmp_path / f"n{k}")
        assert spark.read.parquet(str(tmp_path / f"n{k}")).count() == 24
    run("profile", "--source1", tmp_path / "s1.tsv", "--ground-truth", tmp_path / "gt.tsv", "--output", tmp_path / "profile")
    assert json.loads((tmp_path / "profile/source1.json").read_text())["row_count"] == 24
    assert json.loads((tmp_path / "profile/ground_truth.json").read_text())["total_matches"] == 48
    run("block", "--source1", tmp_path / "n1", "--source2", tmp_path / "n2", "--output", tmp_path / "cand.parquet")
    run("train", "--source1", tmp_path / "n1", "--source2", tmp_path / "n2", "--source3", tmp_path / "n3", "--ground-truth", tmp_path / "gt.tsv", "--output", tmp_path / "m", "--trees", 2, "--depth", 2)
    run("score", "--source1", tmp_path / "n1", "--candidate-source", tmp_path / "n2", "--candidates", tmp_path / "cand.parquet", "--model", tmp_path / "m/package", "--output", tmp_path / "out")
    assert spark.read.csv(str(tmp_path / "out"), sep="\t", header=True).count() == 24 * 4


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.tsv").write_text(TSV.replace('"two\nlines"', "one"))
    normal = stream.normalize_stream(stream.read_stream(spark, str(tmp_path / "in")), "S1")
    target = spark.createDataFrame([("S2-1", 'say "hi"'), ("S2-2", "sayonara"), ("S2-3", "x")], "entity_id string, name_core string")
    q = stream.block_stream(normal, target).writeStream.format("memory").queryName("blocked").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("blocked").collect())) == [("S1-1", "S2-1"), ("S1-1", "S2-2")]
