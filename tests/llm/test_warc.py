import base64
import hashlib

import pytest

from cartulary.llm.common import work_dir
from cartulary.llm.warc import read_archives, read_records, write_archives
from tests.llm.conftest import prose


def pages(spark):
    rows = [(k, f"http://h/{k}", f"<p>{prose(k % 40, 80)}</p>") for k in range(120)] + [(200, None, None), (201, "http://x/\r\ny", ""), (202, "u", "é" * 100_000), (202, "u", "é" * 100_000), (None, "v", "lonely")]
    return spark.createDataFrame([(*r, "k") for r in rows], "page_id bigint, url string, html string, key string"), rows


@pytest.mark.parametrize("least", [0, 1])
def test_round_trip(spark, least):
    df, rows = pages(spark)
    path = work_dir(spark, "warc")
    write_archives(df.repartition(3), path, least)
    got = read_archives(spark, path).collect()
    first = {}
    for k, _, h in rows:
        if k is not None:
            first[h or ""] = min(k, first.get(h or "", k))
    assert len(got) == len(rows)
    for r in got:
        html = next(h or "" for k, _, h in rows if k == r.page_id)
        data = html.encode()
        assert r.payload_bytes == len(data) and r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        again = r.page_id is not None and len(data) >= least and first[html] != r.page_id
        assert (r.record_type, r.refers_to) == (("revisit", first[html]) if again else ("response", None))
        assert r.payload == (None if again else data)


def test_one_id_under_several_payloads(spark):
    """No row is multiplied and no payload lost."""
    rows = [(3, "u", "x" * 90), (5, "u", "x" * 90), (5, "u", "Y" * 90), (5, "u", "z"), (7, "u", "Y" * 90), (7, "u", "Y" * 90), (8, None, "z"), (None, "u", "z"), (None, "u", "lonely"), (9, "u", None), (4, "u", "")]
    path = work_dir(spark, "warc")
    write_archives(spark.createDataFrame(rows, "page_id bigint, url string, html string"), path)
    got = sorted(((r.page_id, r.refers_to, (r.payload or b"").decode()) for r in read_archives(spark, path).collect()), key=str)
    want = [(3, None, "x" * 90), (5, 3, ""), (5, None, "Y" * 90), (5, None, "z"), (7, 5, ""), (7, 5, ""), (8, 5, ""), (None, None, "z"), (None, None, "lonely"), (9, 4, ""), (4, None, "")]
    assert got == sorted(want, key=str)


def test_archives_are_bounded(spark, monkeypatch):
    from cartulary.llm import warc

    monkeypatch.setattr(warc, "BUNDLE_BYTES", 2000)
    monkeypatch.setattr(warc, "BUNDLES", 3)
    df, rows = pages(spark)
    path = work_dir(spark, "warc")
    write_archives(df.where("page_id < 200").coalesce(1), path)
    files = spark.read.format("binaryFile").load(path).select("length", "content").collect()
    assert len(files) > 3 and max(f.length for f in files) < 3 * 2600 + warc.DICTIONARY_BYTES
    assert all(bytes(f.content[:4]) == warc.DICTIONARY_MAGIC for f in files)
    assert sorted(r.page_id for r in read_archives(spark, path).collect()) == list(range(120))


def archive(spark):
    path = work_dir(spark, "warc")
    write_archives(pages(spark)[0].where("page_id < 40").coalesce(1), path)
    return bytes(spark.read.format("binaryFile").load(path).first().content)


def test_damage_is_found(spark):
    data = archive(spark)
    assert len(list(read_records(data))) == 40
    with pytest.raises(ValueError, match="cut short|no frame"):
        list(read_records(data[:-30]))
    with pytest.raises(ValueError, match="dictionary"):
        list(read_records(data[8:]))


def test_standard_tools_read_it(spark):
    import zstandard

    data = archive(spark)
    n = int.from_bytes(data[4:8], "little")
    d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + n]) if n else None)
    text = d.stream_reader(data[8 + n :], read_across_frames=True).read()
    assert text.count(b"WARC/1.1\r\n") == 40


def test_empty_table(spark):
    path = work_dir(spark, "warc")
    write_archives(pages(spark)[0].limit(0), path)
    assert read_archives(spark, path).count() == 0
