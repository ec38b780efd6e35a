"""Records of quoted CSV files, at many block sizes, against the reader that takes a whole file in one task."""

import random

import pytest

from bazaarlens.sources import csv_blocks, csv_ingest

SIZES = "spark.sql.files.maxPartitionBytes"
COST = "spark.sql.files.openCostInBytes"


@pytest.fixture
def blocks(spark):
    """Sets the block size; the session's settings come back."""
    before = {k: spark.conf.get(k) for k in (SIZES, COST)}

    def use(size):
        spark.conf.set(SIZES, size)
        spark.conf.set(COST, 1)

    yield use
    for key, value in before.items():
        spark.conf.set(key, value)


def write(folder, name, rows, end="\n", mark=b"", last=True):
    quoted = lambda f: '"' + f.replace('"', '""') + '"'
    lines = [",".join(f if not set(f) & set('",\r\n') and f and random.Random(f).random() < 0.5 else quoted(f) for f in r) for r in rows]
    text = end.join(["id,text,more", *lines]) + (end if last else "")
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(mark + text.encode())


def random_rows(seed, n=40):
    rnd = random.Random(seed)
    piece = lambda: rnd.choice(["a", "é", "日本", '"', '""', ",", "\n", "\n\n", "\t", "\\", "' ", "word", '"\n"'])
    field = lambda: "".join(piece() for _ in range(rnd.choice((0, 1, 3, 9))))
    return [(str(i), field(), field()) for i in range(n)]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def as_read(rows):
    """An empty field is read as null."""
    return sorted((tuple(f or None for f in r) for r in rows), key=repr)


@pytest.mark.parametrize("size", [3, 16, 64, 400, 1 << 20])
def test_equals_the_one_task_reader(spark, tmp_path, blocks, size):
    folder = tmp_path / "csv"
    for i in range(3):
        write(folder, f"{i}.csv", random_rows(10 * size + i), mark=b"\xef\xbb\xbf" if i == 0 else b"", last=i != 1)
    expected = rows_of(csv_ingest._read_csv(spark, str(folder), True))
    blocks(size)
    got = csv_ingest.read_text_csv(spark, str(folder), multi_line=True)
    assert rows_of(got) == expected and len(expected) == 120
    assert got.columns == ["id", "text", "more"]


def test_windows_lines(spark, tmp_path, blocks):
    write(tmp_path / "csv", "a.csv", random_rows(5), end="\r\n")
    blocks(50)
    got = csv_ingest.read_text_csv(spark, str(tmp_path / "csv"), multi_line=True)
    assert rows_of(got) == as_read(random_rows(5))


def test_as_many_tasks_as_blocks(spark, tmp_path, blocks):
    write(tmp_path / "csv", "a.csv", random_rows(3, 2000))
    size = (tmp_path / "csv" / "a.csv").stat().st_size
    blocks(size // 20)
    lines = csv_blocks.read_lines(spark, str(tmp_path / "csv"))
    assert lines.rdd.getNumPartitions() in (20, 21)
    assert csv_blocks.block_states(lines).count() in (20, 21)
    records = csv_blocks.read_records(spark, str(tmp_path / "csv"))
    assert records.count() == 2001 and records.filter("is_first").count() == 1


def test_one_field_over_many_blocks(spark, tmp_path, blocks):
    long = "line with \"quotes\", commas\n" * 300
    rows = [("1", "x", ""), ("2", long, "after"), ("3", "\n", long), ("4", "", "y")]
    write(tmp_path / "csv", "a.csv", rows)
    blocks(100)
    assert rows_of(csv_ingest.read_text_csv(spark, str(tmp_path / "csv"), multi_line=True)) == as_read(rows)


def test_header_with_line_breaks(spark, tmp_path, blocks):
    (tmp_path / "a.csv").write_text('id,"long\nname","third ""name"""\n1,"a\nb",c\n')
    blocks(4)
    got = csv_ingest.read_text_csv(spark, str(tmp_path / "a.csv"), multi_line=True)
    assert got.columns == ["id", "long\nname", 'third "name"'] and rows_of(got) == [("1", "a\nb", "c")]


@pytest.mark.parametrize("text", [
    'id,text,more\n1,"open,x\n2,b,c\n',  # quote left open
    "id,text,more\n1,a\n",  # short record
    "id,text,more\n1,a,b,c\n",  # surplus field
])
def test_malformed_files_fail(spark, tmp_path, text):
    (tmp_path / "a.csv").write_text(text)
    with pytest.raises(Exception):
        csv_ingest.read_text_csv(spark, str(tmp_path / "a.csv"), multi_line=True).collect()


def test_another_header_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text,more\n1,a,b\n")
    (tmp_path / "b.csv").write_text("id,more,text\n1,a,b\n")
    with pytest.raises(Exception, match="header"):
        csv_ingest.read_text_csv(spark, str(tmp_path), multi_line=True).collect()


def test_empty_lines_and_no_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text,more\n\n1,"\n\n",b\n\n')
    assert rows_of(csv_ingest.read_text_csv(spark, str(tmp_path / "a.csv"), multi_line=True)) == [("1", "\n\n", "b")]
    (tmp_path / "b.csv").write_text("id,text,more\n")
    assert rows_of(csv_ingest.read_text_csv(spark, str(tmp_path / "b.csv"), multi_line=True)) == []


def test_blocks_are_cut_once(spark, tmp_path):
    spark.createDataFrame([(1, "a\nb"), (2, "c")], "n int, x string").repartition(1).write.option("header", True).csv(str(tmp_path / "csv"))
    records = csv_blocks.read_records(spark, str(tmp_path / "csv"))
    assert "MapInArrow" not in records._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["text"] for r in records.collect()) == ["1,\"a\nb\"", "2,c", "n,x"]
