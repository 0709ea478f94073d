"""Source files that tasks can share, and those they cannot."""

import pytest

from ledgerloom.sources import files

PLAIN = 'id,note\n' + ''.join(f'{i},"said ""{i}"", twice"\n{i + 500},NA\n' for i in range(500))


def test_a_large_file_without_line_breaks_in_values_is_split(spark, rows, tmp_path, monkeypatch):
    path = tmp_path / "plain.csv"
    path.write_text(PLAIN)
    whole = files.read_files(spark, {str(path): ("id", "note")})
    assert whole.rdd.getNumPartitions() == 1  # a small file is read as before
    monkeypatch.setattr(files, "WHOLE_BYTES", 1000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000b")
    try:
        split = files.read_files(spark, {str(path): ("id", "note")})
        assert split.rdd.getNumPartitions() > 2
        assert rows(split) == rows(whole) and split.count() == 1000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("odd", [
    '7,"two\nlines"\n', '7,"a ""quote""\nand more"\n', '7,sto"len"\n', '7,a\r\n', '  \n', '7,"x" \n'])
def test_a_file_with_other_lines_is_read_whole(spark, rows, tmp_path, monkeypatch, odd):
    monkeypatch.setattr(files, "WHOLE_BYTES", 1000)
    path = tmp_path / "odd.csv"
    path.write_bytes((PLAIN + odd + "8,end\n").encode())
    assert not files.splittable(spark, str(path))
    found = files.read_files(spark, {str(path): ("id", "note")})
    assert found.rdd.getNumPartitions() == 1
    monkeypatch.setattr(files, "WHOLE_BYTES", 1 << 40)
    assert rows(found) == rows(files.read_files(spark, {str(path): ("id", "note")}))
