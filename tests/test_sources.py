import gzip
from urllib.parse import unquote

import pytest

from feedloom.sources.audit import source_audit
from feedloom.sources.jsonl import first_bad_line, ingest_records, quarantine, read_records


def test_audit_tells_readable_files_from_others(spark, tmp_path, write_jsonl_gz):
    """File names with characters that a URI escapes, and each kind of unfit file."""
    paths = [write_jsonl_gz(n, ['{"k": 1}', "", '{"k": 2}']) for n in ("two words.jsonl.gz", "at=00%3A00.jsonl.gz")]
    (tmp_path / "plain.jsonl.gz").write_text("these bytes are not compressed")
    for name, data in {"late.jsonl.gz": b"  \n{}\n", "empty.jsonl.gz": b"", "latin.jsonl.gz": b'{"k": "\xe9"}\n'}.items():
        with gzip.open(tmp_path / name, "wb") as f:
            f.write(data)
    paths += [str(tmp_path / n) for n in ("plain.jsonl.gz", "late.jsonl.gz", "empty.jsonl.gz", "latin.jsonl.gz")]
    rows = {unquote(r.file.rsplit("/", 1)[-1]): r for r in source_audit(spark, paths).collect()}
    for name in ("two words.jsonl.gz", "at=00%3A00.jsonl.gz"):
        assert (rows[name].status, rows[name].records, rows[name].blank_lines) == ("ok", 2, 1)
    assert {n: r.status for n, r in rows.items() if not r.valid} == {
        "plain.jsonl.gz": "unreadable_or_empty", "late.jsonl.gz": "first_line_blank", "empty.jsonl.gz": "unreadable_or_empty", "latin.jsonl.gz": "invalid_utf8"}


def test_undecodable_bytes_stop_the_ingest(spark, tmp_path):
    path = tmp_path / "odd name.jsonl.gz"
    with gzip.open(path, "wb") as f:
        f.write(b'{"k": 1}\n\n{"k": "\xe9"}\n')
    with pytest.raises(ValueError, match=r"Invalid JSON at odd name.jsonl.gz:3"):
        ingest_records(spark, str(path), str(tmp_path / "out"))


def test_line_number_comes_from_the_bad_file_alone(spark, tmp_path, write_jsonl_gz):
    """A file that arrives between ingest and report shifts other jobs' row numbers, not this one's."""
    bad = write_jsonl_gz("m.jsonl.gz", ['{"k": 1}'] * 7 + ["{cut", '{"k": 2}'])
    assert first_bad_line(spark, f"file://{bad}") == 8
    write_jsonl_gz("a.jsonl.gz", ['{"k": 0}'] * 100)
    assert first_bad_line(spark, f"file://{bad}") == 8 and first_bad_line(spark, f"file://{tmp_path}/a.jsonl.gz") is None


def test_malformed_line_names_file_and_line(spark, write_jsonl_gz):
    path = write_jsonl_gz("reviews.jsonl.gz", ['{"a": 1}', "", "   ", '{"a": 2}', "{broken", '[1, 2]'])
    with pytest.raises(ValueError, match=r"Invalid JSON at reviews.jsonl.gz:5"):
        read_records(spark, path)
    assert read_records(spark, path, mode="permissive").count() == 2
    assert [r.line for r in quarantine(spark, path).orderBy("ordinal").collect()] == ["{broken", "[1, 2]"]


def test_ingest_persists_once_and_keeps_order(spark, tmp_path, write_jsonl_gz):
    a = write_jsonl_gz("a.jsonl.gz", [{"n": i} for i in range(50)])
    b = write_jsonl_gz("b.jsonl.gz", [{"n": 50 + i} for i in range(50)])
    stored = ingest_records(spark, [b, a], str(tmp_path / "ingested"))
    got = [r.n for r in stored.selectExpr("ordinal", "variant_get(v, '$.n', 'int') as n").orderBy("ordinal").collect()]
    assert got == list(range(100))


def test_unicode_blank_lines_are_skipped(spark, write_jsonl_gz):
    path = write_jsonl_gz("u.jsonl.gz", ["　 ", " ", '{"a": 1}'])
    assert read_records(spark, path).count() == 1


def test_audit_flags_undecodable_bytes(spark, tmp_path):
    path = tmp_path / "latin.jsonl.gz"
    with gzip.open(path, "wb") as f:
        f.write(b'{"title": "caf\xe9"}\n')
    row = source_audit(spark, str(path)).first()
    assert row.invalid_utf8_lines == 1 and row.status == "invalid_utf8" and not row.valid
