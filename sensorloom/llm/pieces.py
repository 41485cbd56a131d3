"""SentencePiece encoding with byte offsets, and decoding (operator 5).

A text is normalised by longest-prefix matches in the model's compiled character
map (a double-array trie), and every normalised character keeps the byte of the
text it came from.  Pieces are merged by score inside runs that no vocabulary
piece crosses, so runs are encoded once and remembered (a bounded memory per
worker); piece lengths and the alignment then give each piece its byte span.
The model is read once on the driver and sent to the tasks; its size does not
depend on the data.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sensorloom.sources.tables import table

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
# runs that start with blanks
COARSE = re.compile(r"▁*[^▁]+|▁+")


def fine_runs(pieces) -> re.Pattern:
    """Runs of letters, digits or other characters, with blanks before; numerals that are no digits, as ², count as others."""
    odd = "_" + "".join(sorted({c for p in pieces for c in p if c.isalnum() and not c.isalpha() and not c.isdecimal()}))
    return re.compile(rf"▁*[^\W\d{odd}]+|▁*\d+|▁*(?:[^\w▁\n]|[{odd}])+|▁+|\n")


class CharMap:
    """Longest-prefix replacement by a compiled character map: trie size, trie units, then the replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.texts = blob[4 + size:] if blob else b""

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """(replacement, bytes read) of the longest key at ``at``, or None."""
        if not self.units:
            return None
        found, unit = None, self.units[0]
        node = (unit >> 10) << ((unit & 0x200) >> 6)
        for k in range(at, len(data)):
            node ^= data[k]
            unit = self.units[node]
            if unit & 0x800000FF != data[k]:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit >> 8 & 1:
                found = (self.units[node] & 0x7FFFFFFF, k + 1 - at)
        if found is None:
            return None
        value, read = found
        return self.texts[value: self.texts.index(b"\0", value)], read


class Runs(dict):
    """What runs encode to, remembered: two generations of at most ``room`` short runs each."""

    def __init__(self, make, room: int):
        super().__init__()
        self.make, self.room, self.old = make, room, {}

    def __missing__(self, run: str) -> bytes:
        got = self.old.get(run) or self.make(run)
        if len(run) <= 64:
            if len(self) >= self.room:
                self.old = dict(self)
                self.clear()
            self[run] = got
        return got


NONE = 1 << 62
SIZE = np.uint32(24)  # a piece is its id and, above these bits, its length in characters


class Tokenizer:
    """One model's encoder and decoder.  ``remember`` bounds the runs kept in memory (two generations of that many)."""

    def __init__(self, model: bytes, remember: int = 400_000):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(model)
        if proto.trainer_spec.model_type != 2:
            raise ValueError("only BPE models")
        norm = proto.normalizer_spec
        self.map = CharMap(norm.precompiled_charsmap)
        self.dummy, self.squeeze, self.escape = norm.add_dummy_prefix, norm.remove_extra_whitespaces, norm.escape_whitespaces
        self.suffix = proto.trainer_spec.treat_whitespace_as_suffix
        if self.suffix or not self.escape or any(p.type in (USER, UNUSED) for p in proto.pieces):
            raise ValueError("models with white-space suffixes, bare blanks, user-defined or unused pieces are not read")
        self.unk_surface = proto.trainer_spec.unk_surface
        self.types = [p.type for p in proto.pieces]
        self.pieces = [p.piece for p in proto.pieces]
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        best = sorted((-p.score, i) for i, p in enumerate(proto.pieces) if p.type == NORMAL)
        self.rank = {self.pieces[i]: k for k, (_, i) in enumerate(best)}
        self.unk = self.types.index(UNKNOWN)
        self.bytes = {int(p[1:-1], 16): i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t == BYTE}
        self.back = {i: b for b, i in self.bytes.items()}
        self.names = [str(i) for i in range(len(self.pieces))]
        self.raw = [bytes([self.back[i]]) if t == BYTE else b"" if t == CONTROL else self.unk_surface.encode() if t == UNKNOWN
                    else p.replace(SPACE, " ").encode() for i, (p, t) in enumerate(zip(self.pieces, self.types))]
        whole = lambda rx: all([p] == rx.findall(p) for p in self.rank)
        self.runs = next((rx.findall for rx in (fine_runs(self.rank), COARSE) if whole(rx)), lambda s: [s] if s else [])
        self.known = Runs(lambda run: self._long(run) if len(run) > 256 else self._merge(run), remember)

    # -- normalisation -----------------------------------------------------

    def normal(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its characters and its end the byte of ``text`` it came from."""
        if not text:
            return "", np.zeros(1, np.int64)
        if not self.map.units and not self.squeeze:
            points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
            at = np.zeros(len(text) + 1, np.int64)
            np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF), out=at[1:])
            out = text.replace(" ", SPACE)
            return (SPACE + out, np.concatenate([at[:1], at])) if self.dummy else (out, at)
        data, chars, at, done = text.encode("utf-8"), [], [], 0

        def step(k: int) -> tuple[str, int]:
            if hit := self.map.longest(data, k):
                return hit[0].decode("utf-8"), hit[1]
            n = 1 + (data[k] > 0xBF) + (data[k] > 0xDF) + (data[k] > 0xEF)
            return data[k: k + n].decode("utf-8"), n

        if self.squeeze:
            while done < len(data):
                new, read = step(done)
                if new != " ":
                    break
                done += read
            if done == len(data):
                return "", np.zeros(1, np.int64)
        if self.dummy:
            chars.append(SPACE)
            at.append(done)
        blank = self.squeeze
        while done < len(data):
            new, read = step(done)
            if blank:
                new = new.lstrip(" ")
            if new:
                chars.extend(SPACE if c == " " else c for c in new)
                at.extend([done] * len(new))
                blank = new.endswith(" ")
            done += read
            blank = blank and self.squeeze
        while self.squeeze and chars and chars[-1] == SPACE:
            chars.pop()
            done = at.pop()
        return "".join(chars), np.array([*at, done], np.int64)

    # -- pieces ------------------------------------------------------------

    def _merge(self, run: str) -> bytes:
        """One run's pieces, packed: the best pair is merged first, the leftmost of equals."""
        rank, parts = self.rank.get, list(run)
        pairs = [rank(a + b, NONE) for a, b in zip(parts, parts[1:])]
        while pairs and (least := min(pairs)) != NONE:
            k = pairs.index(least)
            parts[k: k + 2] = [parts[k] + parts[k + 1]]
            del pairs[k]
            if k < len(pairs):
                pairs[k] = rank(parts[k] + parts[k + 1], NONE)
            if k:
                pairs[k - 1] = rank(parts[k - 1] + parts[k], NONE)
        return self._packed(parts)

    def _packed(self, parts: list[str]) -> bytes:
        out = []
        for p in parts:
            if (i := self.ids.get(p)) is not None:
                out.append(i | len(p) << 24)
            elif self.bytes:  # the last byte stands for the character
                out.extend(self.bytes[b] for b in p.encode("utf-8"))
                out[-1] |= 1 << 24
            else:
                out.append(self.unk | 1 << 24)
        return np.array(out, "<u4").tobytes()

    def _long(self, run: str) -> bytes:
        """As _merge, for long runs: a heap of pairs over a linked list, in n log n."""
        import heapq

        rank, n = self.rank, len(run)
        parts: list[str | None] = list(run)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, k, 2) for k in range(n - 1) if (r := rank.get(run[k: k + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            r, k, size = heapq.heappop(heap)
            nxt = right[k] if parts[k] is not None else n
            if nxt >= n or len(parts[k]) + len(parts[nxt]) != size or rank.get(parts[k] + parts[nxt]) != r:
                continue
            parts[k], parts[nxt] = parts[k] + parts[nxt], None
            right[k] = right[nxt]
            if right[k] < n:
                left[right[k]] = k
            for a in (left[k], k):
                if a >= 0 and right[a] < n and (r := rank.get(parts[a] + parts[right[a]])) is not None:
                    heapq.heappush(heap, (r, a, len(parts[a]) + len(parts[right[a]])))
        return self._packed([p for p in parts if p is not None])

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first bytes, end bytes) of the pieces; null as an empty text, which has none.

        Of a character spelled in bytes, the last byte piece spans it and those before it are empty, at its start."""
        norm, at = self.normal(text or "")
        packed = np.frombuffer(b"".join(map(self.known.__getitem__, self.runs(norm))), "<u4")
        ids = (packed & np.uint32((1 << 24) - 1)).astype("<i4")
        ends = np.cumsum(packed >> SIZE, dtype=np.int64)
        begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        if not self.bytes and (ids[1:] == self.unk).any():
            ids, begins, ends = self._join_unknown(ids, begins, ends)
        return ids, at[begins], at[ends]

    def _join_unknown(self, ids, begins, ends):
        """Unknown characters that touch are one piece."""
        first = np.ones(len(ids), bool)
        first[1:] = (ids[1:] != self.unk) | (ids[:-1] != self.unk)
        last = np.append(first[1:], True)
        return ids[first], begins[first], ends[last]

    def decode(self, ids) -> str:
        """The text of ids: blanks for markers, without the one marker that encoding put in front; ill-formed bytes as U+FFFD each."""
        ids = [int(i) for i in ids]
        data = b"".join(map(self.raw.__getitem__, ids))
        try:
            out = data.decode("utf-8")
        except UnicodeDecodeError:
            out = self._decode_broken(ids)
        if self.dummy or self.squeeze:
            start = next((i for i in ids if self.types[i] != CONTROL), None)
            if start is not None and self.types[start] == NORMAL and self.pieces[start].startswith(SPACE):
                lead = self.pieces[start]
                out = out[len(lead) - len(lead.lstrip(SPACE)):] if self.squeeze else out[1:]
        return out

    def _decode_broken(self, ids: list[int]) -> str:
        out, run = [], b""
        for i in [*ids, None]:
            if i is not None and self.types[i] == BYTE:
                run += self.raw[i]
                continue
            while run:
                n = 1 + (run[0] > 0xC1) + (run[0] > 0xDF) + (run[0] > 0xEF)
                try:
                    out.append(run[:n].decode("utf-8"))
                except UnicodeDecodeError:
                    n = 1
                    out.append("�")
                run = run[n:]
            if i is not None:
                out.append(self.raw[i].decode("utf-8"))
        return "".join(out)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


_TOKENIZERS: dict[str, Tokenizer] = {}


def _per_row(docs: DataFrame, text: str, model: str | None, names: list[str], kinds: list[str], make) -> DataFrame:
    """``docs`` without ``text`` and with the columns ``make(tokenizer, text)`` returns; a task holds 128 rows of them at a time."""
    with open(model or model_path(), "rb") as f:
        blob = docs.sparkSession.sparkContext.broadcast(f.read())
    key = hashlib.sha256(blob.value).hexdigest()
    rest = [c for c in docs.columns if c != text and c not in names]
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest] + [f"{n} {k}" for n, k in zip(names, kinds)])
    types = [{"int": pa.int32(), "long": pa.int64(), "string": pa.string()}.get(k) or pa.list_(pa.int32() if "int" in k else pa.int64()) for k in kinds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _TOKENIZERS.get(key) or _TOKENIZERS.setdefault(key, Tokenizer(blob.value))
        for batch in batches:
            for k in range(0, batch.num_rows, 128):
                part = batch.slice(k, 128)
                got = zip(*[make(tok, t) for t in part.column(text).to_pylist()])
                arrays = [pa.array(list(v), t) for v, t in zip(got, types)]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in rest] + arrays, rest + names)

    return docs.select(*rest, text).mapInArrow(run, schema)


def encoded(docs: DataFrame, text: str = "text", model: str | None = None, spans: bool = True) -> DataFrame:
    """``docs`` with ``ids`` and, if ``spans``, ``begins`` and ``ends`` (byte spans) in place of the text.

    Null and empty texts have empty arrays; columns of those names are replaced; row order and number stay."""
    names, kinds = (["ids", "begins", "ends"], ["array<int>", "array<long>", "array<long>"]) if spans else (["ids"], ["array<int>"])
    return _per_row(docs, text, model, names, kinds, lambda tok, t: tok.encode(t)[: len(names)])


def round_trip(docs: DataFrame, text: str = "text", model: str | None = None) -> DataFrame:
    """``docs`` with token counts, digests of ids and of the decoded text, and the bytes that the spans cover, in place of the text."""
    def facts(tok: Tokenizer, t: str | None) -> tuple:
        ids, begins, ends = tok.encode(t)
        listed = ids.tolist()
        return (len(ids), hashlib.sha256(",".join(map(tok.names.__getitem__, listed)).encode()).hexdigest(),
                hashlib.sha256(tok.decode(listed).encode()).hexdigest(), int((ends - begins).sum()))

    return _per_row(docs, text, model, ["n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"], ["long", "string", "string", "long"], facts)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: tokens and digests of every document."""
    return round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))
