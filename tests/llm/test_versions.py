"""Archives of both versions, and files that are none."""

import glob
import re

import pytest

from cellamp.llm import warc


@pytest.fixture
def pages(spark):
    # Payloads that hold the mark of a version line, and other versions' lines.
    texts = ["short", "", "n" * 3000, "WARC/1.", "see WARC/1.0\r\n and WARC/1.7\r\nContent-Length: 3\r\n\r\n", "é" * 700, "WARC/1.0\r\n" * 200]
    return spark.createDataFrame([(k, "u", t) for k, t in enumerate(texts)], "page_id int, url string, html string").coalesce(2)


def _fields(spark, path):
    return sorted(map(tuple, warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type").collect()))


def test_records_of_two_versions(spark, pages, tmp_path):
    path = warc.write_archives(pages, str(tmp_path / "archives"))
    expected = _fields(spark, path)
    assert [r[0] for r in expected] == list(range(7))
    count = 0
    for file in glob.glob(f"{path}/*.txt"):
        with open(file, "rb") as source:
            text = source.read()
        # Every other record becomes one of the older version; a record's first field tells it from a line in a payload.
        heads = [m.start() for m in re.finditer(rb"WARC/1\.1\r\nWARC-Type", text)]
        for at in heads[::2]:
            text = text[:at] + b"WARC/1.0" + text[at + 8 :]
            count += 1
        target = tmp_path / "mixed"
        target.mkdir(exist_ok=True)
        (target / f"{count}.warc").write_bytes(text)
    assert count > 2
    for split in ("128m", "900b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            assert _fields(spark, str(tmp_path / "mixed")) == expected
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("text", ["no archive", "WARC/0.18\r\nContent-Length: 0\r\n\r\n\r\n\r\n", "WARC/1.5\r\nContent-Length: 0\r\n\r\n\r\n\r\n", " WARC/1.1\r\n"])
def test_other_files_are_an_error(spark, tmp_path, text):
    (tmp_path / "x.warc").write_text(text, newline="")
    with pytest.raises(ValueError, match="known version"):
        warc.read_archives(spark, str(tmp_path))
