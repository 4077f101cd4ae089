import random

from pyspark.sql import functions as F

from pointflow import __main__ as cli
from pointflow.plans import programs
from pointflow.sources import points


def test_generate_fit_and_compare(spark, tmp_path):
    kept = spark.sparkContext._jsc.sc().getPersistentRDDs
    before = kept().size()
    path = str(tmp_path / "blobs")
    programs.generate(spark, path, 2000, 4)
    assert points.read_lines(spark, path).count() == 2000
    plain = programs.clusters(spark, path, 4, 10, parts=3, dims=2)
    n, n_a = plain["counts"].first()[:2]
    report = plain["report"].collect()
    assert n == 2000 and len(report) == 4
    assert sum(r["n_a_k"] for r in report) == n_a and sum(r["n_b_k"] for r in report) == n - n_a
    both = programs.fairness(spark, path, 4, 10, selection="population")
    phi = {r["model"]: r["phi"] for r in both["report"].collect()}
    assert set(phi) == {"standard", "fair"} and both["centers"].count() == 8
    assert phi["fair"] < phi["standard"]
    assert kept().size() == before


def test_word_report(spark, tmp_path):
    (tmp_path / "t.txt").write_text("a b a\n\nb  c\n")
    out = programs.word_report(spark, str(tmp_path / "t.txt"), parts=2)
    assert {r["word"]: r["cnt"] for r in out["counts"].collect()} == {"a": 2, "b": 2, "c": 1, "": 2}
    assert tuple(out["summary"].first()) == (3, 7, 4, 0.75)


def test_distinct_report(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    draw = random.Random(0)
    for i in range(6):
        (folder / f"{i}.txt").write_text("".join(f"{draw.randrange(9)}\n" for _ in range(50)))
    out = programs.distinct_report(spark, str(folder), 120)
    assert out["summary"].first()["processed"] == 150
    assert out["sizes"].agg(F.sum("n")).first()[0] == 150


def test_command_line(spark, tmp_path, capsys):
    path = str(tmp_path / "blobs")
    cli.main(["generate", path, "300", "2"])
    cli.main(["clusters", path, "2", "3", "--dims", "2"])
    cli.main(["fairness", path, "2", "3"])
    shown = capsys.readouterr().out
    assert "phi_a" in shown and "standard" in shown
