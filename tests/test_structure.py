"""Ends of PDFs and ZIPs that are cut or forged are told apart from whole ones."""

import io
import random
import zipfile

import pytest

from slotwise.functions import structure


def pdf(objects=3, sections=1, junk=b""):
    """A PDF with so many objects in each of its sections of cross-references."""
    out, place, number = bytearray(junk + b"%PDF-1.5\n"), None, 1
    for _ in range(sections):
        offsets = []
        for _ in range(objects):
            offsets.append(len(out) - len(junk))
            out += f"{number} 0 obj\n<< /V {number} >>\nendobj\n".encode()
            number += 1
        at = len(out) - len(junk)
        out += f"xref\n0 1\n0000000000 65535 f \n{number - objects} {objects}\n".encode() + b"".join(f"{o:010d} 00000 n \n".encode() for o in offsets)
        out += b"trailer\n<< /Size 9" + (f" /Prev {place}".encode() if place is not None else b"") + f" >>\nstartxref\n{at}\n%%EOF\n".encode()
        place = at
    return bytes(out)


@pytest.mark.parametrize("sections", [1, 2, 5])
@pytest.mark.parametrize("junk", [b"", b"\x00junk\n"])
def test_pdfs(sections, junk):
    whole = pdf(4, sections, junk)
    assert structure.pdf(whole) == "ok"
    assert structure.pdf(whole + b"\n" * 1000) == "ok"
    last = whole.rfind(b"startxref")
    for cut in range(last + 1, len(whole) - 6):
        assert structure.pdf(whole[:cut]) in ("truncated", "ok" if sections > 1 and whole[:last].rfind(b"%%EOF") > cut - structure.TAIL else "truncated")
    assert structure.pdf(whole[len(junk) + 5 :]) == "no header"
    place = whole[last:].split()[1]
    assert structure.pdf(whole[:last] + whole[last:].replace(place, b"7", 1)) == "forged"
    assert structure.pdf(whole[:last] + whole[last:].replace(place, b"999999999", 1)) == "forged"
    assert structure.pdf(whole.replace(b"00000 n", b"0000x n", 1)) in ("forged", "ok")
    first = f"{len(b'%PDF-1.5') + 1:010d}".encode()
    assert structure.pdf(whole.replace(first, b"0000000012", 1)) == "forged"
    # bytes added before the table move it away from its place
    body = whole.find(b"endobj")
    assert structure.pdf(whole[:body] + b"%%%%" + whole[body:]) == "forged"


def test_streams_and_loops_of_pdfs():
    head = b"%PDF-1.7\n"
    assert structure.pdf(head + b"8 0 obj << /Type /XRef >> stream\nendstream endobj\nstartxref\n9\n%%EOF") == "ok"
    loop = head + b"xref\n0 1\n0000000000 65535 f \ntrailer << /Prev 9 >>\nstartxref\n9\n%%EOF"
    assert structure.pdf(loop) == "ok"
    assert structure.pdf(head + b"xref\n0 9999999999\n0000000000 65535 f \ntrailer\nstartxref\n9\n%%EOF") == "forged"


def archive(members, comment=b""):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members:
            z.writestr(name, data)
        z.comment = comment
    return out.getvalue()


@pytest.mark.parametrize("comment", [b"", b"made by hand", b"PK\x01\x02" * 3])
def test_archives(comment):
    whole = archive([("a/b.txt", b"x" * 500), ("é.csv", b""), ("c", bytes(range(256)))], comment)
    assert structure.archive(whole) == "ok"
    assert structure.archive(archive([], comment)) == "ok"
    assert all(structure.archive(whole[:cut]) == "truncated" for cut in range(4, len(whole)))
    assert structure.archive(b"x" + whole) == "no header"
    assert structure.archive(whole[:4] + b"xx" + whole[4:]) == "forged"
    end = whole.rfind(b"PK\x05\x06")
    for at, value in ((10, b"\x09\x00"), (12, b"\xff\xff\xff\x00"), (16, b"\x01\x00\x00\x00")):
        assert structure.archive(whole[: end + at] + value + whole[end + at + len(value) :]) == "forged"


def test_noise_raises_nothing():
    rng = random.Random(4)
    for whole, walk in ((pdf(3, 2), structure.pdf), (archive([("a", b"b" * 99)]), structure.archive)):
        for _ in range(2000):
            data = bytearray(whole)
            for _ in range(rng.randint(1, 6)):
                data[rng.randrange(len(data))] = rng.randrange(256)
            assert walk(bytes(data[: rng.randint(0, len(data))])) in ("ok", "no header", "truncated", "forged")


def test_column(spark):
    df = spark.createDataFrame([(1, bytearray(pdf())), (2, bytearray(archive([("a", b"b")])[:-3])), (3, bytearray(b"<html>")), (4, None), (5, bytearray())], "id int, c binary")
    assert [r[0] for r in df.orderBy("id").select(structure.structure("c")).collect()] == ["ok", "truncated", None, None, None]
