import struct

import pytest
from pyspark.sql import functions as F

from loomspark.functions import markup
from loomspark.sources import files


def ibm(value: float) -> bytes:
    """A base-16 float of eight bytes."""
    if value == 0:
        return b"\0" * 8
    sign, value, exponent = (0x80, -value, 64) if value < 0 else (0, value, 64)
    while value >= 1:
        value, exponent = value / 16, exponent + 1
    while value < 1 / 16:
        value, exponent = value * 16, exponent - 1
    return bytes([sign | exponent]) + int(value * 2**56).to_bytes(7, "big")


def transport(rows: list[tuple[float | None, str]]) -> bytes:
    card = lambda s: s.ljust(80).encode()
    name = lambda kind, length, label, at: struct.pack(">hhhh", kind, 0, length, 1) + label.ljust(8).encode() + b" " * 68 + struct.pack(">i", at) + b"\0" * 52
    names = name(1, 8, "AGE", 0) + name(2, 8, "CODE", 8)
    names += b" " * (-len(names) % 80)
    body = b"".join((ibm(a) if a is not None else b"." + b"\0" * 7) + c.ljust(8).encode() for a, c in rows)
    body += b" " * (-len(body) % 80)
    return card("HEADER RECORD*******LIBRARY HEADER RECORD!!!!!!!") + b"HEADER RECORD*******NAMESTR HEADER RECORD!!!!!!!000000" + b"0002" + b"0" * 22 + names + card("HEADER RECORD*******OBS     HEADER RECORD!!!!!!!") + body


def test_transport_round_trip(spark, tmp_path):
    rows = [(1.5, "a"), (None, "bc"), (-118.625, "def"), (0.0, "g")]
    (tmp_path / "x.xpt").write_bytes(transport(rows))
    cells = files.read_transport(spark, str(tmp_path / "*.xpt")).orderBy("row", "variable").collect()
    assert [(cells[2 * k].number, cells[2 * k + 1].text) for k in range(4)] == rows


def test_jsonl_torn_line_and_first_of_key(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": 1, "v": "x"}\n{"k": 1, "v": "y"}\n{"k": 2, "v": "z"}\n{"k": 3, "v')
    rows, torn = files.read_jsonl(spark, str(tmp_path), "k int, v string")
    assert rows.count() == 3 and torn.count() == 1
    assert {r.k: r.v for r in files.read_unique(spark, str(tmp_path), "k int, v string", "k").collect()} == {1: "x", 2: "z"}
    files.append_jsonl(rows, str(tmp_path / "out"))
    files.append_jsonl(rows, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 6


def test_capture_reasons(spark, tmp_path):
    (tmp_path / "ok.md").write_text("text é")
    (tmp_path / "bad.bin").write_bytes(b"\xff\xfe\x00")
    (tmp_path / "big.txt").write_bytes(b"a" * (files.MOST_BYTES + 1))
    found = {r.path.rsplit("/", 1)[1]: r.skipped for r in files.capture(spark, str(tmp_path)).collect()}
    assert found == {"ok.md": None, "bad.bin": "not_text", "big.txt": "too_large"}


def test_import_and_dataset(spark, tmp_path):
    rows = spark.createDataFrame([(1, 2.0), (2, None)], "id int, x double")
    with pytest.raises(ValueError, match="x_there"):
        files.import_all_or_nothing(rows, {"x_there": F.col("x").isNotNull()}, rows, "id")
    assert files.import_all_or_nothing(rows, {"id": F.col("id") > 0}, rows.filter("id = 1"), "id").count() == 1
    manifest = files.write_dataset(rows, str(tmp_path / "d"), "sft")
    assert manifest["rows"] == 2
    with pytest.raises(Exception, match="(?i)exist"):
        files.write_dataset(rows, str(tmp_path / "d"), "sft")
    with pytest.raises(ValueError):
        files.write_dataset(rows.limit(0), str(tmp_path / "e"), "sft")


def test_markdown_of_pages():
    page = "<html><head><title>x</title></head><body><h2>Top &amp; more</h2><p>One <b>two</b> <a href='u'>three</a>.</p><ul><li>a</li><li>b</li></ul><script>no</script><pre>k = 1\n  l</pre></body>"
    text = markup.to_markdown(page)
    assert "## Top & more" in text and "One **two** [three](u)." in text and "- a\n- b" in text and "no" not in text and "```\nk = 1" in text
    assert markup.decode_page("é".encode("cp1252")) == "é" and markup.decode_page(b"<meta charset=utf-8>\xc3\xa9").endswith("é")


def test_sections_and_passages(spark):
    text = "intro é\n# One\nbody\n```\n# not a heading\n```\n## Two\nx"
    cut = markup.sections(text)
    assert [c[0] for c in cut] == [None, "One", "Two"] and cut[0][1] == 0 and cut[-1][2] == len(text.encode())
    assert "".join(text.encode()[a:b].decode() for _, a, b in cut) == text
    rows = spark.createDataFrame([(1, text), (2, None), (3, "")], "k int, t string")
    assert markup.cut_sections(rows, "k", "t").count() == 3
    assert markup.passages(["w " * 100, "w " * 30, "w " * 200, "w " * 5]) == [(0, 1), (2, 2)]
    assert markup.passages(["w " * 5]) == []
