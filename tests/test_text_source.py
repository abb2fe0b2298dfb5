"""Text source: several paths, globs, compressed files, file names."""

from tidelog.session import scratch_path
from tidelog.sources.text import read_log_lines


def test_paths_globs_gzip_and_file_name(spark):
    root = scratch_path(spark, "tests-text")
    a = spark.createDataFrame([(f"a{i}",) for i in range(5)], "value string")
    b = spark.createDataFrame([(f"b{i}",) for i in range(3)], "value string")
    a.coalesce(1).write.text(f"{root}/day=1")
    b.coalesce(1).write.option("compression", "gzip").text(f"{root}/day=2")
    both = read_log_lines(spark, [f"{root}/day=1", f"{root}/day=2"])
    assert sorted(r.value for r in both.collect()) == sorted(
        [f"a{i}" for i in range(5)] + [f"b{i}" for i in range(3)]
    )
    globbed = read_log_lines(spark, f"{root}/day=*/*.gz", with_file_name=True)
    rows = globbed.collect()
    assert len(rows) == 3 and all(r.file_name.endswith(".txt.gz") for r in rows)


def test_recursive_and_file_filter(spark):
    root = scratch_path(spark, "tests-text-nested")
    for day in ("01", "02"):
        spark.createDataFrame([(f"line-{day}",)], "value string").coalesce(1).write.text(
            f"{root}/2024/01/{day}"
        )
    lines = read_log_lines(spark, root, recursive=True, file_filter="part-*")
    assert sorted(r.value for r in lines.collect()) == ["line-01", "line-02"]
