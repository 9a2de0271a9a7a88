"""Audio features of byte payloads kept as 8-bit samples.

A payload is stored as a mono WAV file of unsigned 8-bit samples and read back. Its samples are resampled by a
polyphase filter bank, cut into overlapped windows, turned into log-mel energies and into segments: a segment begins
where a frame's energy passes the upper threshold and lasts until it falls below the lower one. The log-mel matrix is
stored as an Arrow IPC stream holding one fixed-shape tensor column (frames, mels) with each block's time span. The
stream is built for every row and read back, and the digest of the features is taken of what was read: tensors, time
spans and segments.

Long texts are worked through in blocks of fixed size, so a task's memory doesn't grow with a text; block borders
depend on the text alone, so equal texts give equal values.

Edge cases: null texts are empty and have a payload of 64 zero bytes; repeated rows give equal rows; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import io
import wave
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from docloom.llm.shared import documents, id_and_text, map_chunks

RATE, UP, DOWN, TAPS = 16_000, 1, 2, 16
FRAME, HOP, MELS = 256, 128, 24
#: Frames of a stored tensor, and frames worked on at a time.
SPAN, BLOCK = 32, 2048
#: dB over the quiet tenth of the frames at which a segment begins and ends.
ENTER_DB, LEAVE_DB = 3.0, 1.0


def payload_of(text: bytes) -> bytes:
    return text + bytes(-len(text) % 64 or (0 if text else 64))


def to_wav(payload: bytes, rate: int = RATE) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(rate)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


@functools.cache
def filters(up: int = UP, down: int = DOWN, taps: int = TAPS) -> np.ndarray:
    """The low-pass filter's phases, (up, taps): row p holds every up-th coefficient from p on, newest sample first."""
    n = up * taps
    t = np.arange(n) - (n - 1) / 2
    cut = 1.0 / max(up, down)
    h = np.sinc(t * cut) * np.hamming(n)
    return np.ascontiguousarray((h * up / h.sum()).reshape(taps, up).T, dtype=np.float32)


def resampled(x: np.ndarray, up: int = UP, down: int = DOWN, taps: int = TAPS) -> np.ndarray:
    """The samples at up/down times the rate; output k is phase (k*down) % up over the taps that end at (k*down) // up."""
    phases = filters(up, down, taps)
    n = -(-len(x) * up // down)
    padded = np.concatenate([np.zeros(taps - 1, np.float32), x])
    out = np.zeros(n, dtype=np.float32)
    for k0 in range(up):
        step = down  # outputs k0, k0 + up, ... share a phase; their newest inputs are `down` apart
        first, phase = divmod(k0 * down, up)
        own = out[k0::up]
        for j in range(taps):
            own += phases[phase, j] * padded[first + taps - 1 - j :: step][: len(own)]
    return out


@functools.cache
def mel_bank(rate: int = RATE * UP // DOWN, frame: int = FRAME, mels: int = MELS) -> np.ndarray:
    """Triangular filters over the FFT's bins, (bins, mels)."""
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(0, mel(rate / 2), mels + 2) / 2595) - 1)
    f = np.fft.rfftfreq(frame, 1 / rate)[:, None]
    low, mid, high = edges[:-2], edges[1:-1], edges[2:]
    return np.maximum(0, np.minimum((f - low) / (mid - low), (high - f) / (high - mid))).astype(np.float32)


@functools.cache
def taper() -> np.ndarray:
    return np.hanning(FRAME).astype(np.float32)


def log_mel(samples: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(log-mel in tenths of a dB as int16 (frames, mels), energy in dB of each frame)."""
    n = -(-len(samples) * UP // DOWN)
    frames = max(1, -(-(n - FRAME) // HOP) + 1)
    mel, power = np.empty((frames, MELS), np.int16), np.empty(frames)
    for f0 in range(0, frames, BLOCK):
        f1 = min(frames, f0 + BLOCK)
        a, b = f0 * HOP * DOWN // UP, ((f1 - 1) * HOP + FRAME) * DOWN // UP + DOWN
        lead = min(a, TAPS * DOWN)  # what the filter looks back on; a multiple of DOWN, so phases stay
        x = (np.frombuffer(samples, np.uint8)[a - lead : b].astype(np.float32) - 128) / 128
        y = resampled(x)[lead * UP // DOWN :]
        y = np.concatenate([y, np.zeros(max(0, (f1 - f0 - 1) * HOP + FRAME - len(y)), np.float32)])
        windows = np.lib.stride_tricks.sliding_window_view(y, FRAME)[:: HOP][: f1 - f0]
        spectrum = np.fft.rfft(windows * taper(), axis=1)
        energy = spectrum.real**2 + spectrum.imag**2
        mel[f0:f1] = np.rint(100 * np.log10(energy @ mel_bank() + 1e-6)).astype(np.int16)
        power[f0:f1] = np.rint(100 * np.log10((windows**2).sum(axis=1) + 1e-6)) / 10
    return mel, power


def segments(power: np.ndarray, enter: float = ENTER_DB, leave: float = LEAVE_DB) -> list[tuple[int, int]]:
    """Frame ranges by hysteresis: on above floor + enter, off below floor + leave, else as before."""
    floor = np.sort(power)[len(power) // 10]
    event = np.where(power >= floor + enter, 1, np.where(power < floor + leave, -1, 0))
    last = np.maximum.accumulate(np.where(event != 0, np.arange(len(event)), -1))
    on = np.where(last >= 0, event[last] > 0, False)
    edges = np.flatnonzero(np.diff(np.r_[False, on, False].astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def tensor_stream(mel: np.ndarray) -> bytes:
    """An Arrow IPC stream: blocks of SPAN frames as fixed-shape tensors (the last padded with its lowest value), with time spans."""
    blocks = -(-len(mel) // SPAN)
    filled = np.full((blocks * SPAN, MELS), -600, np.int16)
    filled[: len(mel)] = mel
    second = HOP * DOWN / UP / RATE
    begin = np.arange(blocks) * SPAN * second
    end = np.minimum((np.arange(blocks) + 1) * SPAN, len(mel)) * second + (FRAME - HOP) * DOWN / UP / RATE
    batch = pa.record_batch({"tensor": pa.FixedShapeTensorArray.from_numpy_ndarray(filled.reshape(blocks, SPAN, MELS)), "begin_s": begin, "end_s": end})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def read_tensors(stream: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(blocks (n, SPAN, MELS), begin and end of each in seconds) of a stored stream."""
    with pa.ipc.open_stream(stream) as r:
        batch = r.read_next_batch()
    return batch.column("tensor").to_numpy_ndarray(), batch.column("begin_s").to_numpy(), batch.column("end_s").to_numpy()


def feature_of(stream: bytes, spans: list[tuple[int, int]]) -> str:
    """A line on what is stored: the tensors' shape and a digest of their values and time spans and of the segments."""
    tensors, begin, end = read_tensors(stream)
    digest = hashlib.sha256(tensors.tobytes())
    for part in (begin, end, np.array(spans, np.int64)):
        digest.update(part.tobytes())
    shape = "x".join(map(str, tensors.shape))
    return f"logmel {shape} {digest.hexdigest()[:32]} segments {len(spans)} frames {sum(b - a for a, b in spans)}"


def audio_features(docs: DataFrame, stored: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row: payload and media digests, segments as time spans and a digest of the stored features; with `stored` also the media file and the tensors' stream."""

    def one(text: bytes) -> dict:
        media = to_wav(payload_of(text))
        back = from_wav(media)
        mel, power = log_mel(back)
        spans, tensors = segments(power), tensor_stream(mel)
        second = HOP * DOWN / UP / RATE
        out = {
            "n_bytes": len(text), "payload_bytes": len(back), "payload_sha256": hashlib.sha256(back).hexdigest(), "tail_crc32": zlib.crc32(back[-64:]),
            "media_bytes": len(media), "media_sha256": hashlib.sha256(media).hexdigest(), "frames": len(mel),
            "segments": [{"begin_s": a * second, "end_s": b * second} for a, b in spans],
            "feature": feature_of(tensors, spans),
        }
        return out | ({"media": media, "tensors": tensors} if stored else {})

    def run(chunk: pa.RecordBatch) -> dict:
        rows = [one(t) for t in chunk.column("text").fill_null("").cast(pa.binary()).to_pylist()]
        return {"doc_id": chunk.column("doc_id")} | {k: [r[k] for r in rows] for k in rows[0]}

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, frames long, segments array<struct<begin_s double, end_s double>>, feature string"
    return map_chunks(id_and_text(docs, id_col, text_col), run, schema + (", media binary, tensors binary" if stored else ""))


def op7_audio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = audio_features(documents(spark, sf_dir), stored=False)
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
