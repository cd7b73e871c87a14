"""Telephony audio columns: companded and ADPCM sound in WAVE containers, expanded and resampled.

mu-law and A-law samples are expanded by 256-entry tables that are computed from the companding rules. ADPCM blocks
depend on nothing outside themselves, so the decoder runs over the sample positions of a block and, at each, over all
blocks of a batch at once with numpy. Resampling is linear, by a whole factor, and keeps the samples that were there.

Sound and resampled PCM are larger than the texts. ``archived`` therefore takes the rows in slices: it writes the files
and PCM of one to the shared folder, reads them back, keeps what describes them, and removes them before the next.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityspark.llm.common import columns, discard, materialize, slices, text_or_empty, utf8

#: WAVE format tags.
FORMATS = {"mulaw": 7, "alaw": 6, "adpcm": 17}
#: Payload bytes of an ADPCM block, behind its header of 4 bytes.
BLOCK = 64
#: Fixed values of IMA ADPCM: how the step index moves for the three magnitude bits of a nibble, and the largest step index.
INDEX_MOVES = (-1, -1, -1, -1, 2, 4, 6, 8)
LAST_STEP = 88
#: Fixed values of IMA ADPCM: the step sizes.
STEPS = (
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118,
    130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060,
    1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484,
    7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
)


def mulaw_table() -> np.ndarray:
    code = ~np.arange(256, dtype=np.int32) & 0xFF
    size = (((code & 0x0F) << 3) + 0x84 << (code >> 4 & 7)) - 0x84
    return np.where(code & 0x80, -size, size).astype(np.int16)


def alaw_table() -> np.ndarray:
    code = np.arange(256, dtype=np.int32) ^ 0x55
    exponent, mantissa = code >> 4 & 7, (code & 0x0F) << 4
    size = np.where(exponent == 0, mantissa + 8, mantissa + 0x108 << np.maximum(exponent - 1, 0))
    return np.where(code & 0x80, size, -size).astype(np.int16)


def adpcm(blocks: np.ndarray) -> np.ndarray:
    """Decode blocks (n, 4 + bytes) to int16 (n, 2 * bytes): header predictor and step index, then low nibbles first."""
    steps, moves = np.array(STEPS, np.int32), np.array(INDEX_MOVES, np.int32)
    value = blocks[:, :2].copy().view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(blocks[:, 2].astype(np.int32), LAST_STEP)
    body = np.ascontiguousarray(blocks[:, 4:].T)
    out = np.empty((2 * len(body), len(blocks)), np.int16)
    for k in range(len(out)):
        nibble = (body[k >> 1] >> (4 if k & 1 else 0) & 0x0F).astype(np.int32)
        step, size = steps[index], nibble & 7
        change = (step >> 3) + (step * (size & 1) >> 2) + (step * (size >> 1 & 1) >> 1) + step * (size >> 2)
        value = np.clip(np.where(nibble & 8, value - change, value + change), -32768, 32767)
        index = np.clip(index + moves[size], 0, LAST_STEP)
        out[k] = value
    return np.ascontiguousarray(out.T)


def container(codec: str, payload: bytes, rate: int = 8000) -> bytes:
    """A WAVE file that holds the payload byte for byte. ADPCM blocks get a header of zeros each."""
    data, align, bits, extra = payload, 1, 8, b"\0\0"
    if codec == "adpcm":
        data = np.pad(np.frombuffer(payload, np.uint8).reshape(-1, BLOCK), ((0, 0), (4, 0))).tobytes()
        align, bits, extra = BLOCK + 4, 4, struct.pack("<HH", 2, 2 * BLOCK)
    per_s = rate if codec != "adpcm" else rate * align // (2 * BLOCK)
    fmt = struct.pack("<HHIIHH", FORMATS[codec], 1, rate, per_s, align, bits) + extra
    body = b"WAVEfmt " + struct.pack("<I", len(fmt)) + fmt + b"data" + struct.pack("<I", len(data)) + data
    return b"RIFF" + struct.pack("<I", len(body)) + body


def opened(media: bytes) -> tuple[str, int, memoryview]:
    """Codec, sampling rate and the bytes of the data chunk; ValueError where it isn't such a file."""
    view = memoryview(media)
    if view[:4] != b"RIFF" or view[8:12] != b"WAVE":
        raise ValueError("not a WAVE file")
    at, fmt = 12, None
    while at + 8 <= len(view):
        kind, size = bytes(view[at : at + 4]), struct.unpack_from("<I", view, at + 4)[0]
        if kind == b"fmt ":
            fmt = struct.unpack_from("<HHI", view, at + 8)
        elif kind == b"data":
            if fmt is None or fmt[0] not in FORMATS.values():
                raise ValueError("unknown sound format")
            return next(k for k, v in FORMATS.items() if v == fmt[0]), fmt[2], view[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


def payload_of(codec: str, data: memoryview) -> bytes:
    if codec != "adpcm":
        return bytes(data)
    return np.frombuffer(data, np.uint8).reshape(-1, BLOCK + 4)[:, 4:].tobytes()


def decoded(codec: str, data: memoryview) -> np.ndarray:
    """16-bit samples."""
    raw = np.frombuffer(data, np.uint8)
    if codec == "adpcm":
        return adpcm(raw.reshape(-1, BLOCK + 4)).reshape(-1)
    return (mulaw_table() if codec == "mulaw" else alaw_table())[raw]


def resampled(pcm: np.ndarray, factor: int) -> np.ndarray:
    """Linear interpolation; the last sample is held."""
    if factor == 1 or not len(pcm):
        return pcm
    ahead = np.append(pcm[1:], pcm[-1:]).astype(np.int32)
    here = pcm.astype(np.int32)
    return np.stack([(here * (factor - k) + ahead * k) // factor for k in range(factor)], 1).astype(np.int16).reshape(-1)


def store(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rate: int = 8000) -> DataFrame:
    """(doc_id, n_bytes, media): each text's bytes, padded with zeros to a positive multiple of 64, as a WAVE file.

    The codec follows from the payload's CRC-32, so equal texts give equal files. Null texts count as empty (64 zeros).
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codecs = list(FORMATS)
        for batch in slices(batches, "body", 1 << 22):
            data, at = utf8(batch.column("body"))
            raw, files, sizes = data.tobytes(), [], np.diff(at)
            for start, size in zip(at[:-1].tolist(), sizes.tolist(), strict=True):
                payload = raw[start : start + size] + bytes(max(BLOCK, -(-size // BLOCK) * BLOCK) - size)
                files.append(container(codecs[zlib.crc32(payload) % len(codecs)], payload, rate))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(files, pa.binary())], names=["doc_id", "n_bytes", "media"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = columns(docs, doc_id, text).select(F.col(f"`{doc_id}`").alias("doc_id"), text_or_empty(text).alias("body"))
    return rows.mapInArrow(write, f"doc_id {kind}, n_bytes long, media binary")


def expanded(files: list[bytes | None], rate: int) -> list[bytes | None]:
    """Resampled 16-bit PCM of each file; null for null or broken files. All files of a codec are decoded together."""
    parts: list = []
    for x in files:
        try:
            parts.append(opened(x or b""))
        except ValueError:
            parts.append(None)
    out: list[bytes | None] = [None] * len(parts)
    for codec in FORMATS:
        own = [k for k, p in enumerate(parts) if p and p[0] == codec]
        if not own:
            continue
        sound = decoded(codec, memoryview(b"".join(parts[k][2] for k in own)))
        at = 0
        for k in own:
            n = len(parts[k][2]) // (BLOCK + 4) * 2 * BLOCK if codec == "adpcm" else len(parts[k][2])
            out[k] = resampled(sound[at : at + n], max(1, rate // parts[k][1])).astype("<i2").tobytes()
            at += n
    return out


def expand(media: DataFrame, column: str = "media", rate: int = 16000) -> DataFrame:
    """All columns, with pcm (binary, 16-bit little-endian at ``rate``) beside the files. Null or broken files give null; a
    column named pcm is replaced. An empty table gives an empty result."""
    keep = [f for f in media.schema.fields if f.name != "pcm"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(iter([batch]), column, 1 << 21):
                own = part.column(part.schema.get_field_index(column))
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(f.name)) for f in keep), pa.array(expanded(own.to_pylist(), rate), pa.binary())], names=[*(f.name for f in keep), "pcm"])

    return media.select(*[f"`{f.name}`" for f in keep]).mapInArrow(run, f"{schema}, pcm binary")


def describe(stored: DataFrame, rate: int = 16000) -> DataFrame:
    """Describe files and PCM as they are read (doc_id, n_bytes, media, pcm at ``rate``): doc_id, n_bytes, and the payload and
    sound of op7's contract. The sound at its own rate is every so manieth sample of the PCM."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "media", 1 << 21):
            rows = []
            for media_file, pcm in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                codec, own, data = opened(media_file)
                payload = payload_of(codec, data)
                sound = np.frombuffer(pcm, "<i2")[:: max(1, rate // own)]
                wide = sound.astype(np.int64)
                turns = int(np.count_nonzero((sound[1:] < 0) != (sound[:-1] < 0)))
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media_file), hashlib.sha256(media_file).hexdigest(),
                    f"{codec} samples={len(sound)} power={int(wide @ wide) // len(sound)} peak={int(np.abs(wide).max())} turns={turns} pcm{rate}={zlib.crc32(pcm):08x}"))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds))], names=["doc_id", "n_bytes", *names])

    kind = stored.schema["doc_id"].dataType.simpleString()
    return stored.select("doc_id", "n_bytes", "media", "pcm").mapInArrow(run, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def archived(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rate: int = 16000, parts: int = 8) -> DataFrame:
    """Store all texts as sound with their PCM, slice by slice, and describe what is read back: one row a text.

    Texts fall into slices by their hash, so equal texts stand in one. Null texts count as empty; rows with one doc_id, or
    none, are rows of their own; an empty table gives an empty result; further columns are ignored. A very long text is
    one file.
    """
    # A bounded number of slices, each with files of its own.
    slice_of = F.pmod(F.xxhash64(text_or_empty(text)), F.lit(parts))
    found = None
    for k in range(parts):
        stored = materialize(expand(store(docs.filter(slice_of == k), text, doc_id), rate=rate), "sound")
        told = materialize(describe(stored, rate), "described")
        discard(stored)
        found = told if found is None else found.unionByName(told)
    return found
