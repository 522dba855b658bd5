"""Archives whose members are streamed: hostile names and bytes, JSON in pieces, memory that doesn't grow."""

import io
import json
import tracemalloc
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from slotwise.sources import archives, readers

VALUES = st.recursive(st.none() | st.booleans() | st.integers(-(10**12), 10**12) | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=20), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(max_size=5), x, max_size=4), max_leaves=12)


@settings(max_examples=150, deadline=None)
@given(st.lists(VALUES, max_size=6), st.integers(1, 9), st.sampled_from([None, 1]))
def test_json_comes_in_pieces(values, size, indent):
    text = archives.JsonText(io.StringIO(json.dumps(values, indent=indent)), size)
    assert list(text.items()) == values and text.peek() == ""


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.sampled_from(["data", "results", "documents", "x", "y"]), VALUES | st.lists(st.dictionaries(st.text(max_size=3), VALUES, max_size=2), max_size=3), max_size=5))
def test_objects_of_json(data):
    roots = ("data", "results", "documents")
    want = next((data[r] for r in roots if isinstance(data.get(r), list)), [data])
    assert list(archives.json_objects(lambda: io.StringIO(json.dumps(data)), roots)) == [x for x in want if isinstance(x, dict)]


def test_json_that_ends_early():
    for text in ("[1, 2", '{"data": [{"a": 1}, ', "[1 2]", '{"a" 1}'):
        with pytest.raises(ValueError):
            list(archives.json_objects(lambda text=text: io.StringIO(text), ("data",)))


def put(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members:
            z.writestr(name, data)


def test_members_in_batches(spark, tmp_path):
    inner = io.BytesIO()
    put(inner, [("deep.csv", "a\n7\n"), ("/abs.csv", "a\n8\n")])
    put(tmp_path / "one.zip", [("map/p1.csv", b"\xef\xbb\xbfa,b\r\n1,\"x\r\ny\"\"\"\r\n\xff2,\n"), ("../p1.csv", "a\n9\n"), ("c:\\..\\p1.csv", "a\n9\n"), ("map/", ""), ("note.txt", "a\n"), ("in.zip", inner.getvalue()), ("empty.csv", "")])
    put(tmp_path / "two.zip", [("p1.csv", "a\n" + "\n".join(map(str, range(12_000))) + "\n"), ("q.jsonl", '{"a": [1]}\n\n3\n{"b": null}\n')])
    (tmp_path / "_SUCCESS").write_text("a\n")
    out = readers.archive_rows(spark, str(tmp_path), r"\.csv$|zip$", batch=1000)
    rows = [(r["member"], r["pos"], r["row"]) for r in out.collect()]
    assert [x for x in rows if x[0] == "map/p1.csv"] == [("map/p1.csv", 0, {"a": "1", "b": 'x\r\ny"'}), ("map/p1.csv", 1, {"a": "\ufffd2", "b": ""})]
    assert [x[2] for x in rows if x[0] == "in.zip"] == [{"a": "7"}]
    assert [(x[1], int(x[2]["a"])) for x in rows if x[0] == "p1.csv"] == [(i, i) for i in range(12_000)]
    assert {x[0] for x in rows} == {"map/p1.csv", "in.zip", "p1.csv"}
    assert sorted(map(repr, (r["row"] for r in readers.records(spark, str(tmp_path / "two.zip")).collect() if "a" not in r["row"] or r["row"]["a"].startswith("[")))) == sorted(map(repr, [{"a": "[1]"}, {"b": None}]))


def test_members_are_the_partitions(spark, tmp_path):
    put(tmp_path / "x.zip", [(f"m{i}.csv", "a\n" + "1\n" * (5_000 if i == 3 else 10)) for i in range(9)])
    parts = archives.Reader({"path": str(tmp_path), "pattern": "csv$", "target": "100"}).partitions()
    assert [[m for m, _ in p.members] for p in parts] == [["m0.csv", "m1.csv", "m2.csv"], ["m3.csv"], ["m4.csv", "m5.csv", "m6.csv", "m7.csv"], ["m8.csv"]]
    assert archives.members(spark, str(tmp_path), target=100).rdd.getNumPartitions() == 4
    with pytest.raises(FileNotFoundError):
        archives.Reader({"path": str(tmp_path / "none")}).partitions()


def test_a_large_member_takes_little_memory(tmp_path):
    """200 MB of rows, and of one JSON list, from a running decompressor."""
    line = b"1234567890," + b"x" * 989 + b"\n"
    with zipfile.ZipFile(tmp_path / "l.zip", "w", zipfile.ZIP_DEFLATED) as z:
        with z.open("big.csv", "w") as f:
            f.write(b"k,v\n")
            for _ in range(200):
                f.write(line * 1000)
        with z.open("big.json", "w") as f:
            f.write(b'{"meta": {"a": [1, 2]}, "data": [')
            for _ in range(50):
                f.write((b'{"k": "' + b"y" * 990 + b'"},') * 1000)
            f.write(b'{"k": "end"}]}')
    for pattern, rows in (("csv$", 200_000), ("json$", 50_001)):
        reader = archives.Reader({"path": str(tmp_path), "pattern": pattern})
        (part,) = reader.partitions()
        tracemalloc.start()
        n = sum(b.num_rows for b in reader.read(part))
        _, peak = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        assert n == rows and peak < 40 << 20


def test_content_has_a_bound(spark, tmp_path):
    put(tmp_path / "c.zip", [("CIK01.json", "{}"), ("CIK02.json", "x" * 100)])
    assert [(r["member"], bytes(r["content"])) for r in readers.zip_members(spark, str(tmp_path), "CIK01").collect()] == [("CIK01.json", b"{}")]
    reader = archives.Reader({"path": str(tmp_path), "kind": "content", "most": "50"})
    with pytest.raises(ValueError, match="CIK02"):
        [list(reader.read(p)) for p in reader.partitions()]


def test_sheets_are_streamed(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'

    def cell(at, text):
        return f'<c r="{at}" t="inlineStr"><is><t>{text}</t></is></c>'

    late = "".join(f"<row>{cell('A1', 'note')}</row>" for _ in range(30))
    head = f"<row>{cell('A1', ' Symbol ')}{cell('C1', 'NAME')}{cell('AA1', 'Far')}</row>"
    rows = f"<row>{cell('A2', 'ABC')}{cell('AA2', 'f')}</row><row/><row>{cell('B3', ' ')}</row><row>{cell('C4', 'late')}<c r='D4'><v>1</v></c></row>"
    put(tmp_path / "w.xlsx", [("xl/worksheets/a.xml", f"<worksheet {ns}><sheetData>{head}{rows}</sheetData></worksheet>"), ("xl/worksheets/b.xml", f"<worksheet {ns}><sheetData>{late}{head}{rows}</sheetData></worksheet>"), ("xl/worksheets/_rels/a.xml", "<x/>")])
    got = [(r["sheet"], r["row"]) for r in readers.workbook(spark, str(tmp_path / "w.xlsx"), ["name", "symbol"]).collect()]
    assert got == [("xl/worksheets/a.xml", {"Symbol": "ABC", "NAME": "", "Far": "f"}), ("xl/worksheets/a.xml", {"Symbol": "", "NAME": "late", "Far": ""})]
    assert len(readers.workbook(spark, str(tmp_path / "w.xlsx"), ["name", "symbol"], within=31).collect()) == 4
