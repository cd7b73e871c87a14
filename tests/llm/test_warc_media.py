import hashlib
import io
import random
import zlib

import numpy as np
import zstandard
from helpers import empty

from entityspark.llm import media, warc
from entityspark.llm.common import scratch_path

PAGES = "page_id long, url string, html string, digest string, size int, key string"


def pages(spark, rows):
    return spark.createDataFrame([(k, f"http://a/{k}", t, "d", 1, "k") for k, t in rows], PAGES)


def round_trip(spark, rows, **training):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(pages(spark, rows).repartition(3), path, payload="html", **training)
    return path, warc.read_archives(spark, path).collect()


def test_round_trip_revisits_and_dictionary(spark):
    rnd = np.random.RandomState(1)
    words = ["<p>", "</p>", "common", "words", "of", "pages", "<li>", "navigation"]
    text = lambda n: " ".join(rnd.choice(words, n))
    big = "<html>é" + text(900)
    rows = [(1, big), (7, big), (3, big), (4, None), (5, ""), (6, "x" * 999), (8, "x" * 999), (9, "y" * 1000), (2, "y" * 1000), (None, "y" * 1000)] + [(100 + k, text(300)) for k in range(40)]
    path, found = round_trip(spark, rows)
    by = {(r["key"], r["payload_digest"]): r for r in found}
    assert len(found) == len(rows)
    for k, t in rows:
        data = (t or "").encode()
        r = by[None if k is None else str(k), hashlib.sha1(data).hexdigest()]
        last = max((x for x, y in rows if y == t and x is not None), default=None)
        again = len(data) >= 1000 and k != last
        assert r["payload_bytes"] == len(data) and r["record_type"] == ("revisit" if again else "response")
        assert r["refers_to"] == (str(last) if again else None) and r["payload"] == (None if again else data)
        assert r["url"] == f"http://a/{k}"
    files = spark.read.format("binaryFile").load(path).collect()
    assert all(bytes(f["content"][:4]) == b"\x5d\x2a\x4d\x18" for f in files)
    # any reader that knows the dictionary reads the file as one stream
    raw = bytes(files[0]["content"])
    size = int.from_bytes(raw[4:8], "little")
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8 : 8 + size])).stream_reader(io.BytesIO(raw[8 + size :]), read_across_frames=True)
    assert reader.read().count(b"WARC/1.1\r\n") == sum(1 for _ in warc.records(raw))


def test_few_pages_and_empty_table(spark):
    _, found = round_trip(spark, [(1, "a")])
    assert [(r["key"], r["payload"]) for r in found] == [("1", b"a")]
    path = scratch_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([], PAGES), path, payload="html")
    assert warc.read_archives(spark, path).collect() == []


def plain_adpcm(block):
    value, index, out = int.from_bytes(block[:2], "little", signed=True), min(block[2], 88), []
    for byte in block[4:]:
        for n in (byte & 15, byte >> 4):
            step = media.STEPS[index]
            change = (step >> 3) + (step >> 2 if n & 1 else 0) + (step >> 1 if n & 2 else 0) + (step if n & 4 else 0)
            value = max(-32768, min(32767, value - change if n & 8 else value + change))
            index = max(0, min(88, index + media.INDEX_MOVES[n & 7]))
            out.append(value)
    return out


def test_adpcm_matches_a_plain_decoder():
    blocks = np.random.RandomState(3).randint(0, 256, (50, 68)).astype(np.uint8)
    found = media.adpcm(blocks)
    assert found.tolist() == [plain_adpcm(block.tolist()) for block in blocks]


def test_companding_tables():
    mu, a = media.mulaw_table().tolist(), media.alaw_table().tolist()
    assert mu[0] == -32124 and mu[0x80] == 32124 and mu[0xFF] == mu[0x7F] == 0 and a[0xD5] == 8 and a[0x55] == -8 and max(a) == 32256
    assert sorted(mu[:128]) == mu[:128] and len(set(a)) == 256


def test_media_is_lossless(spark):
    texts = [None, "", "abc", "é" * 64, "long " * 30000, "abc"]
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, media string")
    stored = media.store(df)
    rows = {r["doc_id"]: r for r in media.describe(media.expand(stored)).collect()}
    assert sorted(map(str, media.archived(df.withColumnRenamed("media", "pcm"), parts=3).collect())) == sorted(map(str, rows.values()))
    for k, t in enumerate(texts):
        data = (t or "").encode()
        payload = data + bytes(max(64, -(-len(data) // 64) * 64) - len(data))
        r = rows[k]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    assert rows[2]["feature"] == rows[5]["feature"] and rows[2]["media_sha256"] == rows[5]["media_sha256"] and rows[0]["media_sha256"] == rows[1]["media_sha256"]
    wide = media.expand(stored).collect()
    assert all(len(r["pcm"]) % 4 == 0 and len(r["pcm"]) >= 256 for r in wide)
    assert media.archived(empty(spark), parts=2).collect() == []
    broken = spark.createDataFrame([(1, b"RIFF"), (2, None)], "doc_id long, media binary")
    assert [r["pcm"] for r in media.expand(broken).collect()] == [None, None]


def test_features_match_a_plain_count(spark):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("abc xyz.\n") for _ in range(rnd.randint(0, 500))) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    files = {r["doc_id"]: r["media"] for r in media.store(df).collect()}
    tables = {"mulaw": media.mulaw_table().tolist(), "alaw": media.alaw_table().tolist()}
    for r in media.archived(df, parts=2).collect():
        codec, _, data = media.opened(files[r["doc_id"]])
        if codec == "adpcm":
            sound = [x for k in range(0, len(data), 68) for x in plain_adpcm(bytes(data[k : k + 68]))]
        else:
            sound = [tables[codec][b] for b in data]
        wide = []
        for k, x in enumerate(sound):
            ahead = sound[k + 1] if k + 1 < len(sound) else x
            wide += [x, (x + ahead) // 2]
        turns = sum((a < 0) != (b < 0) for a, b in zip(sound, sound[1:], strict=False))
        crc = zlib.crc32(b"".join(x.to_bytes(2, "little", signed=True) for x in wide))
        assert r["feature"] == f"{codec} samples={len(sound)} power={sum(x * x for x in sound) // len(sound)} peak={max(map(abs, sound))} turns={turns} pcm16000={crc:08x}"
