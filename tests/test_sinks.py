from decimal import Decimal
from pathlib import Path

import pytest
from samples import RUN_AT

from tripmart.sinks import write_report


def text(directory, name):
    path = Path(directory) / name
    files = [path] if path.is_file() else sorted(path.glob("part-*"))
    return len(files), b"".join(open(file, "rb").read() for file in files).decode()


def sample(spark):
    rows = [("b, \"x\"", Decimal("2.50"), None), (" a ", None, 1), ("", Decimal("0.00"), 2)]
    return spark.createDataFrame(rows, "name string, amount decimal(10,2), n int").coalesce(1)


def test_report_files(spark, tmp_path):
    assert write_report("Q0_sample", sample(spark), str(tmp_path), RUN_AT) == 3
    assert text(tmp_path, "Q0_sample.csv") == (1, 'name,amount,n\r\n"b, ""x""",2.50,\r\n a ,,1\r\n,0.00,2\r\n')
    assert text(tmp_path, "Q0_sample.md") == (
        1,
        "# Q0_sample\n\n*Run at: 2024-02-01 00:00:00*\n\n| name | amount | n |\n| --- | --- | --- |\n"
        "| b, \"x\" | 2.50 |  |\n|  a  |  | 1 |\n|  | 0.00 | 2 |\n\n*Total: 3 rows*\n",
    )


@pytest.mark.parametrize("count", [0, 3, 3_000, 50_000])
def test_order_is_kept_across_partitions_and_runs_replace_each_other(spark, tmp_path, count):
    for rows in (5, count):
        result = spark.range(rows).repartition(6).orderBy("id")
        assert write_report("ordered", result, str(tmp_path), RUN_AT) == rows
    files, markdown = text(tmp_path, "ordered.md")
    lines = markdown.splitlines()
    assert lines[0] == "# ordered" and lines[-1] == f"*Total: {count} rows*"
    assert lines[6:-2] == [f"| {number} |" for number in range(count)]
    csv_files, table = text(tmp_path, "ordered.csv")
    assert [line for line in table.splitlines() if line != "id"] == [str(number) for number in range(count)]
    assert files == csv_files == 1


def test_empty_result_still_has_a_header(spark, tmp_path):
    assert write_report("none", sample(spark).where("n > 5"), str(tmp_path), RUN_AT) == 0
    assert "| name | amount | n |" in text(tmp_path, "none.md")[1]
    assert text(tmp_path, "none.csv")[1] == "name,amount,n\r\n"


def test_a_long_report_is_a_folder_of_ordered_parts(spark, tmp_path):
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    try:
        for rows in (10, 60_000, 10):
            spark.conf.set(merging, str(rows == 10).lower())
            assert write_report("long", spark.range(rows).repartition(5).orderBy("id"), str(tmp_path), RUN_AT) == rows
            files, table = text(tmp_path, "long.csv")
            assert (files > 1) == (rows > 10) == (tmp_path / "long.csv").is_dir()
            assert [line for line in table.splitlines() if line != "id"] == [str(number) for number in range(rows)]
    finally:
        spark.conf.unset(merging)
    assert sorted(path.name for path in tmp_path.iterdir() if not path.name.startswith(".")) == ["long.csv", "long.md"]


def test_a_result_is_worked_out_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for row in rows:
            seen.add(row.num_rows)
            yield row

    result = spark.range(100).mapInArrow(count, "id long")
    assert write_report("once", result, str(tmp_path), RUN_AT) == 100
    assert seen.value == 100


def test_a_failing_report_keeps_the_last_one(spark, tmp_path):
    write_report("kept", spark.range(3), str(tmp_path), RUN_AT)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        write_report("kept", spark.range(3).selectExpr("1 / (id - id) AS x"), str(tmp_path), RUN_AT)
    assert text(tmp_path, "kept.csv")[1] == "id\r\n0\r\n1\r\n2\r\n"
    assert sorted(path.name for path in tmp_path.iterdir() if not path.name.startswith(".")) == ["kept.csv", "kept.md"]
