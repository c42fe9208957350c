"""Media columns: audio stored losslessly, read back, and turned into log-mel tensors with time spans.

A text's UTF-8 bytes, padded with blanks to a multiple of ``unit``, are the samples of an
8-bit mono wave file. The file is read back, resampled by a polyphase filter, cut into
overlapped frames, and reduced to log-mel filterbank energies; hysteresis on frame energy
gives segments. Features are stored as an Arrow IPC message of fixed-shape tensors, one for
each chunk of ``frames`` frames, with each chunk's time span.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .kernels import text_buffer
from .shared import id_array, long_ids, ship

UNIT = 192
RATE, UP, DOWN, TAPS = 16_000, 2, 3, 24
FRAME, HOP, FFT, MELS, FRAMES = 256, 128, 256, 20, 64
HIGH, LOW = 0.6, 0.4
MEDIA = "doc_id long, n_bytes long, media binary"
FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, tensors binary, segments array<struct<start_s:double,end_s:double>>, feature string"


def wave_bytes(payload: bytes, rate: int = RATE) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(1)
        f.setframerate(rate)
        f.writeframes(payload)
    return out.getvalue()


def read_wave(media: bytes) -> tuple[bytes, int]:
    with wave.open(io.BytesIO(media), "rb") as f:
        return f.readframes(f.getnframes()), f.getframerate()


def _filters() -> np.ndarray:
    """Low-pass taps of each output phase: a windowed sinc at the lower of both rates."""
    n = np.arange(UP * TAPS) - (UP * TAPS - 1) / 2
    taps = np.sinc(n / max(UP, DOWN)) * np.hamming(UP * TAPS)
    taps *= UP / taps.sum()
    return taps.reshape(TAPS, UP).T[:, ::-1].copy()


def _mel_bank(rate: float) -> np.ndarray:
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(0, mel(rate / 2), MELS + 2) / 2595) - 1)
    f = np.fft.rfftfreq(FFT, 1 / rate)
    up = (f[:, None] - edges[None, :-2]) / (edges[1:-1] - edges[:-2])
    down = (edges[None, 2:] - f[:, None]) / (edges[2:] - edges[1:-1])
    return np.maximum(0, np.minimum(up, down)).astype(np.float32)


FILTERS = _filters().astype(np.float32)
BANK = _mel_bank(RATE * UP / DOWN)
WINDOW = np.hanning(FRAME + 1)[:-1].astype(np.float32)
#: Output samples that are worked on at a time, a multiple of HOP.
SPAN = 1 << 17


def resample(samples: np.ndarray) -> np.ndarray:
    """Polyphase resampling by UP/DOWN; the input's ends are padded with silence."""
    x = np.zeros(len(samples) + TAPS + DOWN, np.float32)
    x[TAPS // 2 : TAPS // 2 + len(samples)] = (samples.astype(np.float32) - 128) / 128
    n = len(samples) * UP // DOWN
    out = np.empty(-(-n // UP) * UP, np.float32)
    views = np.lib.stride_tricks.sliding_window_view(x, TAPS)
    for k in range(UP):
        # output i = UP*j + k reads from input (i*DOWN)//UP, at phase (i*DOWN)%UP
        first, phase = divmod(k * DOWN, UP)
        rows = views[first::DOWN][: len(out) // UP]
        out[k::UP][: len(rows)] = rows @ FILTERS[phase]
        out[k::UP][len(rows) :] = 0
    return out[:n]


def log_mel(audio: np.ndarray) -> np.ndarray:
    """Log filterbank energies of overlapped frames; the last frame is filled up with silence."""
    n = max(1, -(-max(0, len(audio) - FRAME) // HOP) + 1)
    padded = np.zeros((n - 1) * HOP + FRAME, np.float32)
    padded[: len(audio)] = audio
    frames = np.lib.stride_tricks.sliding_window_view(padded, FRAME)[::HOP]
    parts = []
    for a in range(0, n, SPAN // HOP):
        spectrum = np.fft.rfft(frames[a : a + SPAN // HOP] * WINDOW, FFT, axis=1)
        parts.append(np.log10((spectrum.real**2 + spectrum.imag**2).astype(np.float32) @ BANK + np.float32(1e-6)))
    return np.concatenate(parts)


def segments(energy: np.ndarray) -> np.ndarray:
    """Frame ranges (first, after) in which the energy stays over the low mark and somewhere reaches the high mark."""
    low, high = np.quantile(energy, [LOW, HIGH])
    over = np.concatenate([[False], energy > low, [False]])
    first, after = np.flatnonzero(over[1:] & ~over[:-1]), np.flatnonzero(~over[1:] & over[:-1])
    hot = np.concatenate([[0], np.cumsum(energy >= high)])
    keep = hot[after] > hot[first]
    return np.stack([first[keep], after[keep]], 1)


TENSOR = pa.fixed_shape_tensor(pa.float32(), (FRAMES, MELS), dim_names=("frame", "mel"))
TENSORS = pa.schema([("start_s", pa.float64()), ("end_s", pa.float64()), ("log_mel", TENSOR)])


def tensor_bytes(mels: np.ndarray) -> bytes:
    """Arrow IPC stream: a fixed-shape tensor and its time span for every chunk of frames."""
    n = -(-len(mels) // FRAMES)
    full = np.full((n * FRAMES, MELS), np.float32(-6))
    full[: len(mels)] = mels
    step = HOP * DOWN / (UP * RATE)
    start = np.arange(n) * FRAMES
    end = np.minimum(start + FRAMES, len(mels))
    storage = pa.FixedSizeListArray.from_arrays(pa.array(full.ravel()), FRAMES * MELS)
    batch = pa.RecordBatch.from_arrays([pa.array(start * step), pa.array(end * step), pa.ExtensionArray.from_storage(TENSOR, storage)], schema=TENSORS)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, TENSORS) as f:
        f.write_batch(batch)
    return sink.getvalue().to_pybytes()


def read_tensors(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def read_frames(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Time spans of the tensors of a message, and their log-mel frames one after another."""
    table = read_tensors(data)
    spans = np.stack([table.column(i).to_numpy() for i in (0, 1)], 1)
    frames = [chunk.storage.flatten().to_numpy(zero_copy_only=False) for chunk in table.column(2).chunks]
    return spans, np.concatenate(frames or [np.zeros(0, np.float32)]).reshape(-1, MELS)


def features(media: bytes) -> tuple[bytes, np.ndarray, bytes, np.ndarray, str]:
    """Payload, log-mel frames, tensors, segments and a digest of what a stored file holds; the digest is over the tensors and their time spans as they are read back."""
    payload, rate = read_wave(media)
    mels = log_mel(resample(np.frombuffer(payload, np.uint8)))
    parts = segments(mels.mean(axis=1))
    tensors = tensor_bytes(mels)
    spans, read = read_frames(tensors)
    read = read[: len(mels)]
    digest = zlib.crc32(parts.astype("<i8").tobytes(), zlib.crc32(np.rint(read * 100).astype("<i4").tobytes(), zlib.crc32(np.rint(spans * 1e6).astype("<i8").tobytes())))
    return payload, mels, tensors, parts, f"frames={len(mels)};mels={MELS};tensors={len(spans)};segments={len(parts)};mean={read.mean(dtype=np.float64):.2f};crc={digest:08x}"


def encode(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", unit: int = UNIT) -> DataFrame:
    """doc_id, n_bytes and the wave file of every text; a null text is empty, and is stored as one unit of blanks."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            buf, offsets = text_buffer(batch.column(1))
            ids, null = long_ids(batch.column(0))
            raw = buf.tobytes()
            for a in range(0, len(ids), 256):
                bounds = offsets[a : a + 257].tolist()
                media = []
                for lo, hi in zip(bounds, bounds[1:], strict=False):
                    size = max(unit, -(-(hi - lo) // unit) * unit)
                    media.append(wave_bytes(raw[lo:hi].ljust(size, b" ")))
                yield pa.RecordBatch.from_arrays([id_array(ids[a : a + 256], null[a : a + 256]), pa.array(np.diff(offsets[a : a + 257])), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(id_column, text_column).mapInArrow(run, MEDIA)


def decode(media: DataFrame) -> DataFrame:
    """Reads every stored file back: digests of file and payload, tensors, segments in seconds, feature digest."""
    ship(media.sparkSession)
    step = HOP * DOWN / (UP * RATE)

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                rows = []
                for x in part.column(2):
                    stored = x.as_py()
                    payload, _, tensors, spans, digest = features(stored)
                    rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), tensors, [{"start_s": s * step, "end_s": e * step} for s, e in spans.tolist()], digest))
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.struct([("start_s", pa.float64()), ("end_s", pa.float64())])), pa.string()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], names=[c.split()[0] for c in FEATURES.split(", ")])

    return media.mapInArrow(run, FEATURES)
