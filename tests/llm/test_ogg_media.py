import hashlib
import random
import zlib

from tidemill.llm import ogg_media as ogg


def bitwise(data):
    crc = 0
    for b in data:
        crc ^= b << 24
        for _ in range(8):
            crc = (crc << 1) ^ (0x04C11DB7 if crc & 0x80000000 else 0)
            crc &= 0xFFFFFFFF
    return crc


def test_checksum_bit_by_bit():
    rng = random.Random(1)
    for n in (0, 1, 7, 300):
        data = rng.randbytes(n)
        assert ogg.checksum(data) == bitwise(data)


def test_packets_over_pages_and_streams():
    rng = random.Random(2)
    for sizes in ([0], [1, 255, 254], [510, 0, 70000, 65025, 3], [200000], [65025 - 255, 255, 9]):
        packets = [(b"head", 0)] + [(rng.randbytes(n), 10 * k + 5) for k, n in enumerate(sizes)]
        other = [(b"other", 0), (rng.randbytes(100000), 77)]
        a, b = ogg.pages(1, packets), ogg.pages(2, other)
        mixed = [a[0], b[0]]
        a, b = a[1:], b[1:]
        while a or b:
            mixed.append((a if a and (not b or rng.random() < 0.5) else b).pop(0))
        report = ogg.read_file(b"".join(mixed))
        assert report.bad_pages == 0 and report.streams[1].packets == [p for p, _ in packets]
        assert report.streams[2].packets == [p for p, _ in other]
        assert all(g in (-1, want) for g, (_, want) in zip(report.streams[1].granules, packets))
        assert report.streams[1].granules[-1] == packets[-1][1] and report.streams[1].begun and report.streams[1].ended


def test_damage_is_found():
    raw = random.Random(3).randbytes(150000)
    data = ogg.write_file(raw)
    sound = ogg.read_sound(data)
    assert sound.samples[: len(raw)] == raw and sound.n_raw == len(raw) and abs(sound.seconds - len(sound.samples) / ogg.RATE) < 1e-9
    broken = bytearray(data)
    broken[len(data) // 2] ^= 1
    report = ogg.read_file(bytes(broken))
    assert report.bad_pages >= 1 and ogg.read_sound(bytes(broken)) is None
    assert ogg.read_sound(b"junk") is None and ogg.read_sound(data[:-10]) is None


def test_query_rows(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, "é" * 32), (4, "a" * 64), (5, "a" * 65), (6, "long " * 30000), (6, "long " * 30000)]
    spark.createDataFrame([(i, t, b"c") for i, t in rows], "doc_id long, text string, media binary").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(ogg.op2_ogg_media(spark, str(tmp_path)).collect(), key=lambda r: r.doc_id)
    for (i, t), r in zip(rows, got):
        raw = (t or "").encode()
        payload = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        assert (r.doc_id, r.n_bytes, r.payload_bytes) == (i, len(raw), len(payload))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-64:])
        assert r.media_sha256 == hashlib.sha256(ogg.write_file(raw)).hexdigest() and r.media_bytes == len(ogg.write_file(raw))
    assert got[0][1:] == got[1][1:] and got[5] == got[6]
    odd = spark.createDataFrame([(1, b"x"), (2, None)], "doc_id long, media binary")
    assert [r.n_bytes for r in ogg.from_media(odd).collect()] == [None, None]
    assert ogg.from_media(odd.filter("doc_id > 5")).collect() == []
