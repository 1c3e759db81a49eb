import json

import pytest
from helpers import frame
from pyspark.sql import functions as F

from corpusloom import session
from corpusloom.operators.formats import with_violations
from corpusloom.sources import jsonl

# The documented shape; the texts are made up here.
SAMPLE = [
    {"instruction": "Write a trigger", "input": "", "output": "trigger T {}", "category": "apex", "subcategory": "triggers",
     "difficulty": "intermediate", "tags": ["trigger", "bulk"]},
    {"instruction": "Show a form", "input": "", "output": "<template/>\n{\"x\": \"é😀\"}", "category": "lwc", "subcategory": "forms",
     "difficulty": "beginner", "tags": []},
]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "apex.jsonl").write_text(json.dumps(SAMPLE[0]) + "\n\n   \n")
    (tmp_path / "lwc.jsonl").write_text(json.dumps(SAMPLE[1], ensure_ascii=False) + "\n")
    (tmp_path / "notes.txt").write_text("not a record")
    return str(tmp_path)


def test_scan(spark, folder):
    rows = jsonl.scan_examples(spark, folder)
    got = sorted((r["_source_file"], r["output"], r["tags"]) for r in rows.collect())
    assert got == [("apex.jsonl", SAMPLE[0]["output"], SAMPLE[0]["tags"]), ("lwc.jsonl", SAMPLE[1]["output"], [])]
    assert jsonl.public_columns(rows).columns == jsonl.CONTRIBUTED.names
    assert with_violations(jsonl.public_columns(rows)).where(F.size("violations") > 0).count() == 0


def test_scan_one_category(spark, folder):
    assert jsonl.scan_examples(spark, f"{folder}/ap*.jsonl").count() == 1


def test_scan_open(spark, folder):
    got = {r["f"]: r["t"] for r in jsonl.scan_open(spark, folder).select(F.col("_source_file").alias("f"), F.try_variant_get("record", "$.tags[1]", "string").alias("t")).collect()}
    assert got == {"apex.jsonl": "bulk", "lwc.jsonl": None}


@pytest.mark.parametrize("scan", [jsonl.scan_examples, jsonl.scan_open])
def test_malformed_line_stops_the_scan(spark, folder, scan):
    with open(f"{folder}/bad.jsonl", "w") as f:
        f.write('{"instruction": "x"\n')
    with pytest.raises(Exception):
        scan(spark, folder).collect()


def test_tolerant_log(spark):
    lines = ["", "no", '{"prompt": "a", "example": {"category": "c"}}', '{"prompt": "b"}', '{"example": {}}', "[1]", "5",
             '{"prompt": "d", "example": null} x', '{"prompt": "e", "example": null}']
    got = {r["prompt"]: r["has_example"] for r in jsonl.tolerant_log(spark.createDataFrame([(x,) for x in lines], "value string")).collect()}
    assert got == {"a": True, "b": False, "e": True}


def test_strict_log(spark, tmp_path):
    path = tmp_path / "log.jsonl"
    path.write_text('{"prompt": "a", "example": {"instruction": "i", "output": "o"}}\n')
    schema = jsonl.strings("instruction", "output")
    assert jsonl.strict_log(spark, str(path), schema).first()["example"]["output"] == "o"
    path.write_text('{"prompt": "a"}\nbroken\n')
    with pytest.raises(Exception):
        jsonl.strict_log(spark, str(path), schema).collect()


def test_by_origin_roundtrip(spark):
    path = session.work_dir(spark, "origin")
    df = frame(spark, "instruction string, _source_file string, _qc string", ("a\nb", "x y.jsonl", "q"), ("é", "z.jsonl", "q"))
    jsonl.write_by_origin(df, path)
    back = jsonl.scan_examples(spark, path, jsonl.strings("instruction"), glob="*.json")
    assert {(r["instruction"], r["_source_file"]) for r in back.collect()} == {("a\nb", "x y.jsonl"), ("é", "z.jsonl")}


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert session.work_dir(spark, "x").startswith(root)
    assert session.work_dir(spark, "x") != session.work_dir(spark, "x")


class Unset:
    """A session that names no shared folder."""

    def __init__(self, master):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})


def test_local_session_without_the_setting():
    assert session.shared_root(Unset("local[2]")) == session.shared_root(Unset("local[*]"))


def test_cluster_without_the_setting_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(Unset("spark://host:7077"))
