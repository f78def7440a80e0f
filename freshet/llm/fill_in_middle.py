"""Fill-in-middle over seekable compressed frames.

A text is stored as independent zstandard frames with the numbers of units and code points before each. A cut at a unit
opens only the frame it falls into; every other frame goes into the output as it is stored, and digests stream the frames
in order, so no more than one frame of a text is ever unpacked.
"""

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import functions as F

from freshet.llm.common import SPACE, slices
from freshet.sources.layers import materialise

FRAME_BYTES = 1 << 16  # of text in a frame, at least
SEED = 42
MOVED = 50             # per cent of the texts that are not left plain
SPM = 80               # per cent of those that start with the suffix
PREFIX, SUFFIX, MIDDLE = MARKS = (b"<P>", b"<S>", b"<M>")

FRAMES_SCHEMA = "doc_id long, frames array<binary>, units array<long>, chars array<long>, marked boolean"
OUTPUT_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output array<binary>"
DIGEST_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


# --- frames ---------------------------------------------------------------------------------------------------

def _code_points(part):
    return len(part) - int(np.count_nonzero((np.frombuffer(part, np.uint8) & 0xC0) == 0x80))


def _unit_starts(part, first):
    """Where units begin: at the first byte of a text, and wherever a gap follows a word."""
    gap = SPACE[np.frombuffer(part, np.uint8)]
    at = np.flatnonzero(gap[1:] & ~gap[:-1]) + 1
    return np.concatenate([[0], at]) if first and len(part) else at


def _cut_frames(text, size):
    """Parts of a text; none splits a code point, and none but the first begins with a unit."""
    at = 0
    while at < len(text):
        to = min(len(text), at + size)
        while to < len(text) and text[to] & 0xC0 == 0x80:
            to += 1
        if to < len(text) and SPACE[text[to]] and not SPACE[text[to - 1]]:
            to += 1
        yield text[at:to]
        at = to


def store_frames(docs, key="doc_id", text="text", frame_bytes=FRAME_BYTES):
    """Texts as frames, written to the shared folder: doc_id, frames, units and chars (numbers before each frame and, last,
    of the whole text), marked (the text holds one of the marks).

    A unit is a word with the whitespace before it, or the whitespace at the end. A null text is stored as an empty one,
    which has no frame. Null and repeated ids and repeated rows stay rows of their own; other columns are left out.
    """
    def pack(batches):
        press = zstandard.ZstdCompressor(3)
        for batch in slices(batches):
            rows = []
            for i, x in zip(batch["doc_id"].to_pylist(), batch["text"].cast("binary").to_pylist(), strict=True):
                frames, units, chars = [], [0], [0]
                for part in _cut_frames(x or b"", frame_bytes):
                    units.append(units[-1] + len(_unit_starts(part, not frames)))
                    chars.append(chars[-1] + _code_points(part))
                    frames.append(press.compress(part))
                rows.append((i, frames, units, chars, any(m in (x or b"") for m in MARKS)))
            yield _batch(rows, FRAMES)

    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return materialise(plain.mapInArrow(pack, FRAMES_SCHEMA), "text-frames")


_LISTS = {"frames": pa.list_(pa.binary()), "output": pa.list_(pa.binary()), "units": pa.list_(pa.int64()), "chars": pa.list_(pa.int64()),
          "marked": pa.bool_(), "form": pa.string(), "output_sha256": pa.string(), "restored_sha256": pa.string()}


def _columns(schema):
    names = [part.split()[0] for part in schema.split(", ")]
    return pa.schema([(n, _LISTS.get(n, pa.int64())) for n in names])


FRAMES, OUTPUT, DIGEST = _columns(FRAMES_SCHEMA), _columns(OUTPUT_SCHEMA), _columns(DIGEST_SCHEMA)


def _batch(rows, schema):
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


class Frames:
    """The frames of one text, with the places of its units."""

    def __init__(self, frames, units, chars):
        self.frames, self.units, self.chars = frames, units, chars

    def seek(self, unit):
        """(frame, byte in it, code points before it) of the start of a unit, or of the end after the last one."""
        if unit == self.units[-1]:
            return len(self.frames), 0, self.chars[-1]
        f = int(np.searchsorted(self.units, unit, "right")) - 1
        part = unpack(self.frames[f])
        at = int(_unit_starts(part, f == 0)[unit - self.units[f]])
        return f, at, self.chars[f] + _code_points(part[:at])

    def between(self, start, end):
        """Whole frames as (frame, None) and parts of cut ones as (None, bytes), in order."""
        (f, a, _), (g, b, _) = start, end
        for k in range(f, min(g + 1, len(self.frames))):
            low, high = a if k == f else 0, b if k == g else None
            if high == 0:
                continue
            if low == 0 and high is None:
                yield self.frames[k], None
            else:
                yield None, unpack(self.frames[k])[low:high]


def unpack(frame):
    return zstandard.ZstdDecompressor().decompress(frame)


# --- transformation -------------------------------------------------------------------------------------------

def draws(key, seed):
    """The four numbers that decide on a document; a null id is drawn by the word null."""
    digest = hashlib.sha256(f"{seed}:{'null' if key is None else key}".encode()).hexdigest()
    return [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]


def choose(key, n, marked, seed=SEED, moved=MOVED, spm=SPM):
    """Form of a document and the units after which prefix and middle end."""
    h1, h2, h3, h4 = draws(key, seed)
    if n == 0 or marked or h3 % 100 >= moved:
        return "plain", 0, 0
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return "spm" if h4 % 100 < spm else "psm", a, b


def _join(pieces):
    """Output frames: stored frames as they are, everything between two of them as one new frame."""
    press, loose = zstandard.ZstdCompressor(3), []
    for frame, part in pieces:
        if frame is None:
            loose.append(part)
            continue
        if any(loose):
            yield press.compress(b"".join(loose))
        loose = []
        yield frame
    if any(loose):
        yield press.compress(b"".join(loose))


def fill_in_middle(stored, seed=SEED, moved=MOVED, spm=SPM):
    """Per stored text: doc_id, n (units), form, prefix_chars, middle_chars (null if plain), output (its frames).

    Texts that are empty, hold a mark or are not drawn stay plain. The others become <P>prefix<S>suffix<M>middle (psm) or
    <S>suffix<P>prefix<M>middle (spm), cut before units.
    """
    def move(batches):
        for batch in slices(batches):
            rows = []
            for r in batch.to_pylist():
                n = r["units"][-1]
                form, a, b = choose(r["doc_id"], n, r["marked"], seed, moved, spm)
                if form == "plain":
                    rows.append((r["doc_id"], n, form, None, None, r["frames"]))
                    continue
                text = Frames(r["frames"], r["units"], r["chars"])
                cuts = (0, 0, 0), text.seek(a), text.seek(b), (len(text.frames), 0, text.chars[-1])
                parts = dict(zip((PREFIX, MIDDLE, SUFFIX), zip(cuts, cuts[1:], strict=False), strict=True))
                order = (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE)
                pieces = (p for mark in order for p in [(None, mark), *text.between(*parts[mark])])
                rows.append((r["doc_id"], n, form, cuts[1][2], cuts[2][2] - cuts[1][2], list(_join(pieces))))
            yield _batch(rows, OUTPUT)

    return stored.mapInArrow(move, OUTPUT_SCHEMA)


# --- reading back ---------------------------------------------------------------------------------------------

class Output:
    """An output as a stream of bytes; sizes stand in the heads of the frames, so a range opens only its own frames."""

    def __init__(self, frames):
        self.frames = frames
        self.ends = np.cumsum([zstandard.frame_content_size(f) for f in frames], dtype=np.int64)

    def read(self, start=0, end=None):
        end = int(self.ends[-1]) if end is None and len(self.ends) else end or 0
        for k in range(int(np.searchsorted(self.ends, start, "right")), len(self.frames)):
            base = int(self.ends[k - 1]) if k else 0
            if base >= end:
                return
            yield unpack(self.frames[k])[max(0, start - base):end - base]

    def find(self, mark, start):
        """Byte of the first `mark` from `start` on; it may lie across frames."""
        tail, base = b"", start
        for part in self.read(start):
            at = (tail + part).find(mark)
            if at >= 0:
                return base - len(tail) + at
            base += len(part)
            tail = (tail + part)[1 - len(mark):]
        raise ValueError(f"no {mark!r} in the output")

    def restored(self, form):
        """The original text, as parts in order."""
        if form == "plain":
            return self.read()
        m = len(PREFIX)
        first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
        at = self.find(second, m)
        end = self.find(MIDDLE, at + m)
        place = {first: (m, at), second: (at + m, end), MIDDLE: (end + m, None)}
        return (part for mark in (PREFIX, MIDDLE, SUFFIX) for part in self.read(*place[mark]))


def _sha256(parts):
    digest = hashlib.sha256()
    for part in parts:
        digest.update(part)
    return digest.hexdigest()


def digests(outputs):
    """Outputs with the digest of their bytes and of the text that output and form give back, both read frame by frame."""
    def read(batches):
        for batch in slices(batches):
            rows = []
            for r in batch.to_pylist():
                out = Output(r["output"])
                rows.append((*[r[c] for c in DIGEST.names[:5]], _sha256(out.read()), _sha256(out.restored(r["form"]))))
            yield _batch(rows, DIGEST)

    return outputs.mapInArrow(read, DIGEST_SCHEMA)


def _split(mark):
    return f"array_to_string({mark}, '')"


ORACLE_SQL = rf"""
WITH cut AS (SELECT doc_id, coalesce(text, '') AS text, sha256('{SEED}:' || doc_id) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
  drawn AS (SELECT *, len(u) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM cut),
  placed AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= {MOVED} THEN 'plain'
      WHEN h4 % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form FROM drawn),
  parts AS (SELECT *, CASE WHEN a > 0 THEN {_split('u[1:a]')} ELSE '' END AS p, CASE WHEN b > a THEN {_split('u[a+1:b]')} ELSE '' END AS m,
    CASE WHEN n > b THEN {_split('u[b+1:n]')} ELSE '' END AS s FROM placed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM parts"""
