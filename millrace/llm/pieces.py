"""SentencePiece encoding and decoding by batched numpy Viterbi.

Text becomes words at the places that no piece spans (before a run of the space mark). Distinct words of equal length
advance together: at each end position, hashes of the substrings of every piece length that end there probe the sorted hashes of
all pieces, each hit is scored, and the best one with its backpointer is kept.

A unigram model takes the largest sum of piece scores. A BPE model's encoding is the one segmentation whose neighbouring
pieces are all stable, which means that merging the pair's characters by rank gives the pair back; so each end position has one
piece that can stand last after a stable beginning, and the maximum is taken over the stable ones. Whether a pair is stable is
read off the merge trees: no merge across the border comes before those that use up its two parts.

Characters without a piece become byte pieces if the model has them, else the unknown piece.

Cases: null and empty texts have no pieces; a literal space mark is read as a space, as the format has it; repeated
rows get the same pieces; an empty table gives an empty table; extra columns pass by."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.runtime import map_blocks
from millrace.llm.textblock import U, mix
from millrace.session import ship_package

MARK = "▁"
_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
#: Words that a worker remembers, and the longest that it does; then it starts afresh.
REMEMBER, REMEMBER_CHARS = 200_000, 64
#: Characters of words that advance together at most.
BATCH_CHARS = 1 << 20
_BASE = U(0x9E3779B97F4A7C15)
_models: dict[int, Model] = {}


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Model:
    """The pieces of a SentencePiece model file, read from its bytes."""

    def __init__(self, data: bytes):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_proto=data)
        self.n = sp.vocab_size()
        self.pieces = [sp.id_to_piece(i) for i in range(self.n)]
        self.unk = sp.unk_id()
        self.bpe = _model_type(data) == 2
        self.score = np.array([sp.get_score(i) for i in range(self.n)])
        byte = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if sp.is_byte(i)}
        self.byte_id = np.array([byte.get(b, self.unk) for b in range(256)], np.int32)
        self.has_bytes = len(byte) == 256
        self.byte_of = {i: b for b, i in byte.items()}
        normal = [i for i in range(self.n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.longest = max(len(self.pieces[i]) for i in normal)
        codes = [np.array([ord(c) for c in self.pieces[i]], np.uint64) for i in normal]
        h = np.array([_hash_one(c) for c in codes], U)
        order = np.argsort(h)
        self.keys, self.ids = h[order], np.array(normal, np.int64)[order]
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.keys >> U(44)).astype(np.int64)] = True
        self.sizes = sorted({len(c) for c in codes})
        if self.bpe:
            self._trees({self.pieces[i]: i for i in normal})
        self.bytes_of = np.empty(self.n, object)
        for i, p in enumerate(self.pieces):
            self.bytes_of[i] = bytes([self.byte_of[i]]) if i in self.byte_of else b"" if sp.is_control(i) else " ⁇ ".encode() if i == self.unk else p.replace(MARK, " ").encode()
        self.known: dict[str, bytes] = {}
        # answers about pairs, each in the one slot that its hash gives it
        self.stable_keys, self.stable_is = np.full(1 << 20, -1, np.int64), np.zeros(1 << 20, bool)

    def _trees(self, id_of: dict[str, int]) -> None:
        """Merge ranks, all two-part splits of pieces into pieces, and the pieces along each piece's left and right edges."""
        rank = {i: -self.score[i] for i in id_of.values()}
        self.rank = np.full(self.n + 1, np.inf)
        for i, r in rank.items():
            self.rank[i] = r
        splits = [(id_of[p[:k]] * (self.n + 1) + id_of[p[k:]], i) for p, i in id_of.items() for k in range(1, len(p)) if p[:k] in id_of and p[k:] in id_of]
        splits.sort()
        self.split_key, self.split_id = np.array([s[0] for s in splits], np.int64), np.array([s[1] for s in splits], np.int64)
        halves = {i: self._last_merge(p, id_of, rank) for p, i in id_of.items() if len(p) > 1}
        edges = []
        for side in (1, 0):  # right edges of left neighbours, left edges of right neighbours
            rows = []
            for i in range(self.n + 1):
                row = [i]
                while row[-1] in halves and halves[row[-1]]:
                    row.append(halves[row[-1]][side])
                rows.append(row[::-1])
            depth = max(map(len, rows)) + 1
            # behind the last part stands n, of infinite rank: nothing uses the whole piece up
            edges.append((np.array([r + [self.n] * (depth - len(r)) for r in rows], np.int64), np.array([len(r) for r in rows])))
        (self.right_edge, self.right_deep), (self.left_edge, self.left_deep) = edges

    @staticmethod
    def _last_merge(piece: str, id_of: dict[str, int], rank: dict[int, float]):
        """The two parts whose merge makes the piece when its characters are merged by rank; None if they never do."""
        parts = list(piece)
        while len(parts) > 2:
            best = min(((rank[id_of[a + b]], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in id_of), default=None)
            if best is None:
                return None
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return (id_of[parts[0]], id_of[parts[1]]) if parts[0] in id_of and parts[1] in id_of else None

    def stable(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each pair of pieces stays a pair; n stands for a character without a piece, which merges with nothing."""
        key = a * (self.n + 1) + b
        slot = (mix(key.astype(U)) >> U(44)).astype(np.int64)
        out = self.stable_is[slot]
        new = np.flatnonzero(self.stable_keys[slot] != key)
        if len(new):
            ask, first, back = np.unique(key[new], return_index=True, return_inverse=True)
            ok = self._stable(ask // (self.n + 1), ask % (self.n + 1))
            self.stable_keys[slot[new[first]]], self.stable_is[slot[new[first]]] = ask, ok
            out[new] = ok[back]
        return out

    def _stable(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """One pass over every (part on a's right edge, part on b's left edge)."""
        deep_a, deep_b = self.right_deep[a], self.left_deep[b]
        each = deep_a * deep_b
        pair = np.repeat(np.arange(len(a)), each)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(each) - each, each)
        j, i = k // deep_b[pair], k % deep_b[pair]
        x, y = self.right_edge[a[pair], j], self.left_edge[b[pair], i]
        key = x * (self.n + 1) + y
        at = np.minimum(np.searchsorted(self.split_key, key), len(self.split_key) - 1)
        hit = np.flatnonzero(self.split_key[at] == key)
        pair, j, i, x, y, merged = pair[hit], j[hit], i[hit], x[hit], y[hit], self.rank[self.split_id[at[hit]]]
        # parts live from their own merge (a character always) to the one that uses them up; of equal merges the left one comes first
        born = np.maximum(np.where(j > 0, self.rank[x], -np.inf), np.where(i > 0, self.rank[y], -np.inf))
        when = np.maximum(merged, born)
        used_a, used_b = self.rank[self.right_edge[a[pair], j + 1]], self.rank[self.left_edge[b[pair], i + 1]]
        ok = np.ones(len(a), bool)
        ok[pair[(when < used_a) & (when <= used_b)]] = False
        return ok

    def words_of(self, text: str) -> list[str]:
        return _WORD.findall(MARK + text.replace(" ", MARK)) if text else []

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """Piece ids (int32 bytes) of words, those of equal length in one batch."""
        by: dict[int, list[str]] = {}
        for w in words:
            by.setdefault(len(w), []).append(w)
        out: dict[str, bytes] = {}
        for size, group in by.items():
            step = max(1, BATCH_CHARS // size)
            for k in range(0, len(group), step):
                part = group[k : k + step]
                out.update(zip(part, self._viterbi(part, size)))
        return out

    def _viterbi(self, words: list[str], size: int) -> list[bytes]:
        n = len(words)
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, size)
        prefix = np.zeros((size + 1, n), U)
        for t in range(size):
            prefix[t + 1] = prefix[t] * _BASE + (chars[:, t].astype(U) + U(1))
        power = np.array([pow(int(_BASE), k, 2**64) for k in range(self.longest + 1)], U)
        best = np.full((size + 1, n), -np.inf)
        best[0] = 0.0
        last = np.full((size + 1, n), -1, np.int64)  # piece that ends here; self.n is a character without one
        back = np.zeros((size + 1, n), np.int32)
        lowest = float(self.score[self.ids].min()) - 10.0
        for t in range(1, size + 1):
            for k in self.sizes:
                if k > t:
                    break
                h = mix(prefix[t] - prefix[t - k] * power[k])
                maybe = np.flatnonzero(self.filter[(h >> U(44)).astype(np.int64)])
                if not len(maybe):
                    continue
                at = np.minimum(np.searchsorted(self.keys, h[maybe]), len(self.keys) - 1)
                hit = self.keys[at] == h[maybe]
                row, piece = maybe[hit], self.ids[at[hit]]
                self._offer(best, last, back, t, k, row, piece, self.score[piece])
            lost = np.flatnonzero(~np.isfinite(best[t])) if not self.bpe else np.flatnonzero(last[t] < 0)
            single = self._no_piece(chars[lost, t - 1]) if len(lost) else lost
            row = lost[single] if len(lost) else lost
            if len(row):
                best[t, row], last[t, row], back[t, row] = best[t - 1, row] + lowest, self.n, 1
        ends = np.full(n, size)
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        rows = np.arange(n)
        while len(rows):
            piece = last[ends[rows], rows]
            steps.append((rows, np.where(piece == self.n, -1 - chars[rows, ends[rows] - 1].astype(np.int64), piece)))
            ends[rows] -= back[ends[rows], rows]
            rows = rows[ends[rows] > 0]
        row = np.concatenate([s[0] for s in steps][::-1])
        ids = np.concatenate([s[1] for s in steps][::-1])
        order = np.argsort(row, kind="stable")
        row, ids = row[order], ids[order]
        cut = np.searchsorted(row, np.arange(n + 1))
        raw = ids.astype(np.int32).tobytes()
        out = [raw[4 * a : 4 * b] for a, b in zip(cut.tolist(), cut[1:].tolist())]
        for r in np.unique(row[ids < 0]):
            out[r] = self._with_bytes(ids[cut[r] : cut[r + 1]])
        return out

    def _offer(self, best, last, back, t, k, row, piece, score) -> None:
        """Take the pieces that improve on what ends at t."""
        if self.bpe:
            before = last[t - k, row]
            ok = (before >= 0) if t > k else np.ones(len(row), bool)
            inner = np.flatnonzero(ok) if t > k else np.zeros(0, np.int64)
            if len(inner):
                ok[inner] = self.stable(before[inner], piece[inner])
            row, piece, score = row[ok], piece[ok], score[ok]
        total = best[t - k, row] + score
        up = total > best[t, row]
        row = row[up]
        best[t, row], last[t, row], back[t, row] = total[up], piece[up], k

    def _no_piece(self, chars: np.ndarray) -> np.ndarray:
        h = mix(chars.astype(U) + U(1))
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return self.keys[at] != h

    def _with_bytes(self, ids: np.ndarray) -> bytes:
        out: list[int] = []
        for i in ids.tolist():
            if i >= 0:
                out.append(i)
            elif self.has_bytes:
                out += self.byte_id[list(chr(-1 - i).encode("utf-8", "surrogatepass"))].tolist()
            elif not out or out[-1] != self.unk:
                out.append(self.unk)
        return np.array(out, np.int32).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Piece ids of whole texts as int32 bytes."""
        split = [self.words_of(t or "") for t in texts]
        wanted = set().union(*split) if split else set()
        if len(self.known) > REMEMBER:
            self.known = {}
        known = self.known
        new = {w for w in wanted if w not in known}
        made = self.learn(new)
        known.update((w, b) for w, b in made.items() if len(w) <= REMEMBER_CHARS)
        look = known.__getitem__ if all(len(w) <= REMEMBER_CHARS for w in new) else lambda w: known[w] if w in known else made[w]
        return [b"".join(map(look, words)) for words in split]

    def decode(self, ids: bytes) -> str:
        """The text again: bytes of all pieces, less the space put before it."""
        raw = b"".join(self.bytes_of[np.frombuffer(ids, np.int32)].tolist())
        text = raw.decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def _hash_one(codes: np.ndarray) -> np.uint64:
    h = np.zeros(1, U)
    for c in codes:
        h = h * _BASE + (c + U(1))
    return mix(h)[0]


def _model_type(data: bytes) -> int:
    """trainer_spec.model_type of a model file (1 unigram, 2 BPE), read from the protobuf wire format."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            b = data[at]
            value |= (b & 127) << shift
            at, shift = at + 1, shift + 7
            if b < 128:
                return value, at

    def fields(at: int, end: int):
        while at < end:
            tag, at = varint(at)
            kind = tag & 7
            if kind == 0:
                value, at = varint(at)
            elif kind == 2:
                size, at = varint(at)
                value, at = (at, at + size), at + size
            else:
                value, at = None, at + (8 if kind == 1 else 4)
            yield tag >> 3, value

    for number, span in fields(0, len(data)):
        if number == 2:
            return next((v for k, v in fields(*span) if k == 3), 1)
    return 1


def model_from(data: bytes) -> Model:
    key = hash(data)
    if key not in _models:
        _models[key] = Model(data)
    return _models[key]


#: Bytes of text encoded at once: the more, the more distinct words advance together.
ENCODE_BYTES = 4 << 20


def _shared(docs: DataFrame, path: str | None):
    ship_package(docs.sparkSession)
    with open(path or default_model(), "rb") as f:  # of fixed size; goes to the workers with the broadcast
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids, the pieces of every whole text."""
    shared = _shared(docs, path)

    def run(text: pa.Array) -> list:
        made = model_from(shared.value).encode(text.to_pylist())
        off = np.concatenate(([0], np.cumsum([len(b) // 4 for b in made]))).astype(np.int32)
        return [pa.ListArray.from_arrays(off, np.frombuffer(b"".join(made), np.int32))]

    return map_blocks(docs, run, ["doc_id"], [T.StructField("ids", T.ArrayType(T.IntegerType()))], limit=ENCODE_BYTES)


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of encoded documents."""
    shared = _shared(encoded, path)
    kind = encoded.schema["doc_id"]

    def run(batches):
        for batch in batches:
            model = model_from(shared.value)
            text = [model.decode(np.array(x or [], np.int32).tobytes()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, T.StructType([kind, T.StructField("text", T.StringType())]))


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 (of the ids as little-endian int32) and round_trip (decoding gives the text again)."""
    shared = _shared(docs, path)

    def run(text: pa.Array) -> list:
        model = model_from(shared.value)
        texts = text.to_pylist()
        made = model.encode(texts)
        same = [model.decode(b) == (t or "").replace(MARK, " ") for t, b in zip(texts, made)]
        return [np.array([len(b) // 4 for b in made], np.int64), np.array([zlib.crc32(b) for b in made], np.int64), np.array(same, bool)]

    fields = [T.StructField("n_pieces", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("round_trip", T.BooleanType())]
    return map_blocks(docs, run, ["doc_id"], fields, limit=ENCODE_BYTES).select("doc_id", "n_pieces", "ids_crc32", F.col("round_trip"))
