"""Line breaks in quoted fields, whatever the places where files and chunks are cut."""

from __future__ import annotations

import csv
import io
import random

import pyarrow as pa
import pytest

from quillframe import TableError, read_csv
from quillframe.sources.records import _cutter, cut_records, quoted_records

FIELDS = ["", "x", "two words", 'say "no"', "a,b", "line\nbreak", "\n", '"\n"', "\r\n", "é\n\nü", "1.5"]


def written(seed, rows=400, end="\r\n"):
    draw, out = random.Random(seed), io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    table = [[str(i), draw.choice(FIELDS), draw.choice(FIELDS) * draw.randrange(1, 4)] for i in range(rows)]
    writer.writerows([["id", "multi\nline", "c"], *table])
    return out.getvalue(), table


@pytest.mark.parametrize(("end", "chunk"), [("\n", 10), ("\r\n", 100), ("\n", 8 << 20)])
def test_records_are_those_of_a_sequential_reader(spark, tmp_path, end, chunk):
    tables = []
    for i in range(3):
        text, table = written(i, end=end)
        (tmp_path / f"{i}.csv").write_bytes(text.encode())
        tables += table
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        records = quoted_records(spark, [str(tmp_path)], chunk).collect()
        if chunk > 10:
            read = read_csv(spark, str(tmp_path), multiline=True).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(next(csv.reader(io.StringIO(r["record"], newline=""))) for r in records if not r["heading"]) == sorted(tables)
    assert [r["record"].rstrip("\r") for r in records if r["heading"]] == ['id,"multi\nline",c'] * 3
    if chunk > 10:
        kept = sorted(((int(i), b or None, c or None) for i, b, c in tables), key=repr)
        assert sorted(((r[0], r[1], r[2]) for r in read), key=repr) == kept


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    text, table = written(5, 3000)
    (tmp_path / "big.csv").write_bytes(text.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        records = quoted_records(spark, [str(tmp_path / "big.csv")], 1000)
        files = {f for f in records.inputFiles()}
        assert records.count() == 3001
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(files) > 8  # the stored chunks of as many tasks


def test_a_record_longer_than_many_chunks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,"' + "line\n" * 500 + '"\n2,x\n')
    assert [(r[0], r[1]) for r in quoted_pairs(quoted_records(spark, [str(tmp_path)], 20))] == [("1", "line\n" * 500), ("2", "x")]


def quoted_pairs(records):
    return sorted(next(csv.reader(io.StringIO(r["record"], newline=""))) for r in records.where("NOT heading").collect())


def test_pieces_of_a_chunk():
    assert cut_records("a\nb", False) == [("whole", "a"), ("whole", "b")]
    assert cut_records('x"\ny\n"z', True) == [("head", 'x"'), ("whole", "y"), ("tail", '"z')]
    assert cut_records("x\ny", True) == [("through", "x\ny")]


@pytest.mark.parametrize("multiline", [False, True])
@pytest.mark.parametrize("row", ["3,,5", "3,4,", "3,4,,5", "3,4,5", ",,", '3,"4,4",5', '3,"4",'])
def test_surplus_fields_are_refused_whichever_is_empty(spark, tmp_path, row, multiline):
    (tmp_path / "a.csv").write_text(f'a,b\n1,2\n"1,1",\n5\n{row}\n')
    with pytest.raises(TableError, match="1 rows have more fields"):
        read_csv(spark, str(tmp_path / "a.csv"), multiline=multiline)
    with pytest.raises(TableError, match="1 rows have more fields"):
        read_csv(spark, str(tmp_path), _texts(), multiline=multiline)


def _texts():
    from pyspark.sql import types as T

    return T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])


def test_short_rows_blank_lines_and_open_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿a,b\n1,2\n\n5\n"7\n7",8\n')
    read = read_csv(spark, str(tmp_path / "a.csv"), multiline=True)
    assert sorted(map(tuple, read.collect()), key=str) == [("1", 2), ("5", None), ("7\n7", 8)]
    (tmp_path / "b.csv").write_text('a,b\n1,"2\n3,4\n')
    with pytest.raises(TableError, match="quote"):
        read_csv(spark, str(tmp_path / "b.csv"), multiline=True)
    (tmp_path / "c.csv").write_text("a,c\n1,2\n")
    with pytest.raises(TableError, match="different headers"):
        read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "c.csv")], multiline=True)


def test_chunks_of_one_batch_are_cut_one_at_a_time():
    """The batches of records stay small however many chunks come in one batch."""
    text = "\n".join(f'{i},"a b"' for i in range(25_000))
    rows = {"file": ["f"] * 4, "block": [0] * 4, "chunk": [0, 1, 2, 3], "inside": [False] * 4, "text": [text] * 4}
    cut = list(_cutter(fragments=False)(iter([pa.RecordBatch.from_pydict(rows)])))
    assert max(batch.num_rows for batch in cut) <= 10_000 and sum(batch.num_rows for batch in cut) == 100_000
    assert [row["heading"] for batch in cut[:1] for row in batch.slice(0, 2).to_pylist()] == [True, False]
