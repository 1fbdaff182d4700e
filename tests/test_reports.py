from pyspark.sql import functions as F

from groundmill import cli
from groundmill.operators import passes, substance
from groundmill.reports import review, scorecard_table


def test_substance(spark):
    refs = "array<struct<role:string,entity_id:string,entity_type:string,canonical:string>>"
    rows = [("This passage describes a call.", ["x"], [("actor", "e1", "actor", "x")], False), ("Anna Quill denied it on 2024-01-05.", ["anna quill"], [("actor", "e2", "actor", "x")], False), (None, None, None, True), ("", [], [], None)]
    df = spark.createDataFrame(rows, f"m string, s array<string>, r {refs}, d boolean")
    got = df.select(substance.speaks_of_itself(F.col("m")), substance.unresolved_hooks(F.col("m"), F.col("s")), substance.has_substance(F.col("r"), F.array(F.lit("e1")), F.col("d"))).collect()
    assert [tuple(r) for r in got] == [(True, [], False), (False, ["2024-01-05"], True), (False, [], True), (False, [], False)]


def test_markdown(spark):
    card = spark.createDataFrame([(3, 0.5)], "proposals int, pass_rate double")
    assert scorecard_table({"a|b": card}).splitlines()[2].startswith("| a\\|b | 3 |")
    chunks = spark.createDataFrame([("c1", ["k"])], "chunk_id string, keywords array<string>")
    text = review(passes.review(chunks.select("chunk_id"), words=chunks), passes.vocabulary(chunks, "keywords"))
    assert "## c1" in text and "Terms: k" in text


def test_cli(capsys):
    assert cli.main(["--list"]) == 0 and "p5_found" in capsys.readouterr().out
    assert cli.main(["nothing", "/x"]) == 2


def test_review_has_every_chunk(spark):
    chunks = spark.range(131).selectExpr("lpad(id, 3, '0') AS chunk_id", "array('k') AS keywords")
    reviewed = passes.review(chunks.select("chunk_id"), words=chunks)
    assert review(reviewed).count("\n## ") == 131
    text = review(reviewed, chunks=50)
    assert text.count("\n## ") == 50 and "81 more chunks are not shown" in text and "not shown" not in review(reviewed, chunks=131)
