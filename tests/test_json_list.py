"""List-shaped JSON in byte ranges: equal to a whole parse wherever the ranges end."""

import json
import random

import pytest

from lodgeframe.sources import json_list as JL
from lodgeframe.sources.files import read_json_corpus

SCHEMA = "a string, b array<string>, c struct<d:string,e:bigint>"


def value(rnd):
    text = lambda: "".join(rnd.choices(['"', "\\", ",", "[", "]", "{", "}", "é", "🙂", " ", "x,y", "\n", "end"], k=rnd.randrange(12)))
    row = {"a": text(), "b": [text() for _ in range(rnd.randrange(3))], "c": {"d": text(), "e": rnd.randrange(99)}}
    return {k: v for k, v in row.items() if rnd.random() < 0.9}


def rows_of(df):
    return sorted(json.dumps(r.asDict(recursive=True), sort_keys=True) for r in df.collect())


def expected(values):
    full = lambda v: {"a": v.get("a"), "b": v.get("b"), "c": v.get("c")}
    return sorted(json.dumps(full(v), sort_keys=True) for v in values)


@pytest.mark.parametrize("range_bytes", [60, 333, 1 << 20])
def test_ranges_of_any_size(spark, tmp_path, range_bytes):
    rnd = random.Random(range_bytes)
    values = [value(rnd) for _ in range(60)]
    values.append({"a": "long " * 300 + ", end"})
    for name, part, layout in (("a", values[:25], {}), ("b", values[25:], {"indent": 1}), ("c", [], {})):
        (tmp_path / f"{name}.json").write_text(json.dumps(part, ensure_ascii=rnd.random() < 0.5, **layout))
    (tmp_path / "d.json").write_text(" \n ")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert rows_of(JL.read_json_list(spark, str(tmp_path), SCHEMA, range_bytes)) == expected(values)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_many_tasks_read_one_file(spark, tmp_path):
    values = [{"a": f"row {i}, with commas, and [brackets]", "b": [str(i)] * 3} for i in range(4000)]
    (tmp_path / "one.json").write_text(json.dumps(values))
    found = JL.elements(spark, str(tmp_path / "one.json"), range_bytes=40_000)
    assert found.count() == 4000 and found.rdd.getNumPartitions() >= 8
    (tmp_path / "lines").write_text("\n".join(map(json.dumps, values)))
    lines = spark.read.schema(SCHEMA).json(str(tmp_path / "lines"))
    assert rows_of(JL.read_json_list(spark, str(tmp_path / "one.json"), SCHEMA, 40_000)) == rows_of(lines)


@pytest.mark.parametrize("text", ['{"a": "x"}', '[{"a": "x"}', '[{"a": "x"}] tail', '"text"', '[{"a": "x"]}]'])
def test_not_a_list(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match="list"):
        JL.elements(spark, str(tmp_path)).collect()


def test_written_lists_come_back(spark, tmp_path):
    df = spark.createDataFrame([("x", ["1", "2"], ("d", 1)), (None, None, None), ("y,[", [], ("", None))], SCHEMA).repartition(5)
    JL.write_json_lists(df, str(tmp_path / "lists"))
    back = read_json_corpus(spark, str(tmp_path / "lists"), df.schema, list_file=True)
    assert rows_of(back) == rows_of(df)
