"""SentencePiece encoding and decoding: Aho-Corasick over the pieces, one Viterbi pass."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import chunks, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁".encode()
LITERAL = 0xFF  # stands for a space mark that is in the text itself; no UTF-8 text holds this byte
FEW = 24  # units that are left when the rest has ended
CACHE = 200_000  # distinct words remembered by a worker; the memory begins anew beyond that


def load_pieces(path: str = MODEL) -> list[tuple[str, float, int]]:
    """(piece, score, kind) by id; kind 0 normal, 1 control or unknown, 2 byte."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(m.id_to_piece(i), m.get_score(i), 2 if m.is_byte(i) else 1 if m.is_control(i) or m.is_unknown(i) else 0) for i in range(m.get_piece_size())]


class Automaton:
    """Aho-Corasick over the UTF-8 bytes of the pieces, with a dense transition table.

    A piece's score is the model's; a character that is no piece itself costs the least score less 10
    and becomes byte pieces (the unknown piece where the model lacks them). Of equally good
    segmentations, the one with the longest last piece wins.
    """

    def __init__(self, pieces: list[tuple[str, float, int]]):
        normal = [(p.encode(), s, i) for i, (p, s, kind) in enumerate(pieces) if kind == 0 and p]
        self.unknown = min((s for _, s, _ in normal), default=0.0) - 10
        self.bytes = np.full(256, -1, np.int64)
        for i, (p, _, kind) in enumerate(pieces):
            if kind == 2:
                self.bytes[int(p[3:5], 16)] = i
        self.unk_id = next((i for i, (p, _, kind) in enumerate(pieces) if kind == 1 and p == "<unk>"), 0)
        self.text = [b"" if kind == 1 else bytes([int(p[3:5], 16)]) if kind == 2 else p.encode().replace(SPACE, b" ") for p, _, kind in pieces]
        # a run of space marks opens a word; cutting there is exact if no piece has a mark after another character
        self.cuts = all("▁" not in p.lstrip("▁") for p, _, kind in pieces if kind == 0)
        trie: list[dict[int, int]] = [{}]
        end = [-1]
        for b, _, i in normal:
            at = 0
            for x in b:
                if x not in trie[at]:
                    trie[at][x] = len(trie)
                    trie.append({})
                    end.append(-1)
                at = trie[at][x]
            end[at] = i
        n = len(trie)
        goto = np.zeros((n, 256), np.uint16 if n <= 65536 else np.uint32)
        fail, link = np.zeros(n, np.int64), np.full(n, -1, np.int64)
        queue = []
        for x, to in trie[0].items():
            goto[0, x] = to
            queue.append(to)
        for at in queue:  # grows
            f = fail[at]
            goto[at] = goto[f]
            for x, to in trie[at].items():
                fail[to] = goto[f, x]
                goto[at, x] = to
                queue.append(to)
            link[at] = f if end[f] >= 0 else link[f]  # the next shorter suffix that is a piece
        end = np.array(end)
        self.goto, self.link = goto, link
        self.first = np.where(end >= 0, np.arange(n), link)  # the longest piece that ends here, as a state
        size = {i: len(b) for b, _, i in normal}
        score = {i: s for _, s, i in normal}
        self.id = end
        self.len = np.array([size.get(i, 0) for i in end])
        self.score = np.array([score.get(i, 0.0) for i in end])

    def encode(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units end to end, and where each unit's begin. All units advance in step, a byte at a time."""
        size = np.array([len(u) for u in units], np.int64)
        order = np.argsort(-size, kind="stable")
        base = np.zeros(len(units) + 1, np.int64)
        np.cumsum(size + 1, out=base[1:])
        data = np.frombuffer(b"\0".join([*units, b""]), np.uint8)
        best = np.full(len(data), -np.inf)
        best[base[:-1]] = 0.0
        came, by = np.zeros(len(data), np.int64), np.full(len(data), -1, np.int64)
        lead = np.where((data & 0xC0) != 0x80, np.arange(len(data)), 0)
        lead = np.maximum.accumulate(lead)  # where each byte's character begins
        state = np.zeros(len(units), np.int64)
        sorted_base, down = base[order], np.sort(size)
        for step in range(int(size.max(initial=0))):
            live = len(units) - int(np.searchsorted(down, step, "right"))
            if live < FEW and step >= FEW:  # a few long units: one after the other is quicker than in step
                for u in range(live):
                    self._alone(data, lead, best, came, by, int(sorted_base[u]), step, int(size[order[u]]), int(state[u]))
                break
            at = sorted_base[:live] + step
            state[:live] = self.goto[state[:live], data[at]]
            to, node = at + 1, self.first[state[:live]]
            begun = lead[at]
            ends = (data[to] & 0xC0) != 0x80
            alone = np.zeros(live, bool)
            rows = np.flatnonzero(node >= 0)
            while len(rows):
                hit = node[rows]
                start = to[rows] - self.len[hit]
                cost = best[start] + self.score[hit]
                better = cost > best[to[rows]]
                up = rows[better]
                best[to[up]], came[to[up]], by[to[up]] = cost[better], start[better], self.id[hit[better]]
                alone[rows[start == begun[rows]]] = True
                node[rows] = self.link[hit]
                rows = rows[node[rows] >= 0]
            odd = np.flatnonzero(ends & ~alone)
            if len(odd):
                cost = best[begun[odd]] + self.unknown
                better = cost > best[to[odd]]
                up = odd[better]
                best[to[up]], came[to[up]], by[to[up]] = cost[better], begun[up], -2
        at = base[:-1] + size
        path_unit, path_at, path_id = [], [], []
        rows = np.flatnonzero(size)
        at = at.copy()
        while len(rows):
            here = at[rows]
            path_unit.append(rows)
            path_at.append(here)
            path_id.append(by[here])
            at[rows] = came[here]
            rows = rows[at[rows] > base[rows]]
        unit, here, ids = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (path_unit, path_at, path_id))
        order = np.argsort(here, kind="stable")
        unit, here, ids = unit[order], here[order], ids[order]
        odd = np.flatnonzero(ids == -2)
        if len(odd):  # characters without a piece become their bytes
            spread = [self._bytes(data[came[e] : e].tobytes()) for e in here[odd]]
            many = np.ones(len(ids), np.int64)
            many[odd] = [len(x) for x in spread]
            where = np.repeat(np.cumsum(many) - many, 1)
            out = np.repeat(ids, many)
            for i, x in zip(odd, spread, strict=True):
                out[where[i] : where[i] + len(x)] = x
            ids, unit = out, np.repeat(unit, many)
        return ids, np.searchsorted(unit, np.arange(len(units) + 1))

    def _alone(self, data, lead, best, came, by, base: int, step: int, size: int, state: int) -> None:
        """The same relaxation for one unit from a step on."""
        goto, first, link, length, score, piece = self.goto.reshape(-1), self.first, self.link, self.len, self.score, self.id
        end = base + size
        cost, back, last = best[base : end + 1].tolist(), came[base : end + 1].tolist(), by[base : end + 1].tolist()
        begin, raw = lead[base:end].tolist(), data[base : end + 1].tobytes()
        for i in range(step, size):
            state = int(goto[state * 256 + raw[i]])
            node, to, begun, alone = int(first[state]), i + 1, begin[i] - base, False
            while node >= 0:
                n = int(length[node])
                c = cost[to - n] + float(score[node])
                if c > cost[to]:
                    cost[to], back[to], last[to] = c, base + to - n, int(piece[node])
                if to - n == begun:
                    alone = True
                node = int(link[node])
            if not alone and (to == size or (raw[to] & 0xC0) != 0x80):
                c = cost[begun] + self.unknown
                if c > cost[to]:
                    cost[to], back[to], last[to] = c, base + begun, -2
        best[base : end + 1], came[base : end + 1], by[base : end + 1] = cost, back, last

    def _bytes(self, char: bytes) -> list[int]:
        ids = self.bytes[list(SPACE if char == bytes([LITERAL]) else char)]
        return [self.unk_id] if (ids < 0).any() else ids.tolist()

    def units(self, text: str) -> list[str]:
        """The text as words, each without the one space that opens it; further spaces stay in front."""
        parts = text.split(" ")
        if not self.cuts:
            return [text]
        if "" not in parts:
            return parts
        out, held = [], ""
        for p in parts[:-1]:
            if p:
                out.append(held + p)
                held = ""
            else:
                held += " "
        out.append(held + parts[-1])
        return out

    @staticmethod
    def marked(unit: str) -> bytes:
        return SPACE + unit.encode("utf-8", "surrogatepass").replace(SPACE, bytes([LITERAL])).replace(b" ", SPACE)

    def decode(self, ids) -> str:
        """Control pieces vanish, the space that opens the text too."""
        return b"".join(map(self.text.__getitem__, ids))[1:].decode("utf-8", "replace")


class Encoder:
    """An automaton with a bounded memory of words already segmented."""

    def __init__(self, automaton: Automaton):
        self.automaton, self.memory = automaton, {}
        self.ids, self.at = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        a = self.automaton
        split = [a.units(t) if t else [] for t in texts]
        new = list(dict.fromkeys(u for s in split for u in set(s) if u not in self.memory))
        if len(self.memory) + len(new) > CACHE:
            self.memory, self.ids, self.at = {}, np.zeros(0, np.int32), np.zeros(1, np.int64)
            new = list(dict.fromkeys(u for s in split for u in s))
        if new:
            ids, at = a.encode([a.marked(u) for u in new])
            self.memory.update(zip(new, range(len(self.at) - 1, len(self.at) - 1 + len(new)), strict=True))
            self.at = np.concatenate((self.at, at[1:] + len(self.ids)))
            self.ids = np.concatenate((self.ids, ids.astype(np.int32)))
        out = []
        for s in split:
            w = np.fromiter(map(self.memory.__getitem__, s), np.int64, len(s))
            start, size = self.at[w], self.at[w + 1] - self.at[w]
            end = np.cumsum(size)
            out.append(self.ids[np.arange(end[-1] if len(end) else 0) + np.repeat(start - (end - size), size)])
        return out


_READY: dict[str, Automaton] = {}


def _automaton(key: str, pieces) -> Automaton:
    """One automaton a worker, kept from task to task."""
    if key not in _READY:
        _READY.clear()
        _READY[key] = Automaton(pieces.value)
    return _READY[key]


def _sent(spark: SparkSession, path: str):
    pieces = load_pieces(path)
    return hashlib.sha256(repr(pieces).encode()).hexdigest(), spark.sparkContext.broadcast(pieces)


def encoded(docs: DataFrame, path: str = MODEL, text: str = "text") -> DataFrame:
    """docs with token_ids (array<int>), n_tokens (long) and round_trip (boolean).

    The model file is read on the driver; its pieces (a vocabulary, bounded by the file) are broadcast.
    Spaces become space marks, one more opens the text, nothing else is normalised, so that decoding
    gives back the text: round_trip says that it does. A null text gives null ids, 0 tokens and a true
    round trip, an empty text an empty list; repeated rows get equal ids, an empty table gives none. Columns
    of docs that have these names are replaced. Without the model file the call fails before any job starts.
    """
    spark = docs.sparkSession
    key, pieces = _sent(spark, path)
    docs = docs.drop("token_ids", "n_tokens", "round_trip")

    def run(batches):
        encoder = Encoder(_automaton(key, pieces))
        for batch in chunks(batches, text):
            texts = batch.column(text).to_pylist()
            ids = encoder([t or "" for t in texts])
            good = [t is None or encoder.automaton.decode(x.tolist()) == t for t, x in zip(texts, ids, strict=True)]
            at = np.zeros(len(ids) + 1, np.int32)
            np.cumsum([len(x) for x in ids], out=at[1:])
            flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32(), mask=np.append([t is None for t in texts], False)), flat)
            new = [lists, pa.array(np.diff(at).astype(np.int64)), pa.array(good)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, "token_ids", "n_tokens", "round_trip"])

    schema = T.StructType([*docs.schema.fields, T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()), T.StructField("round_trip", T.BooleanType())])
    return docs.mapInArrow(run, schema)


def decoded(rows: DataFrame, path: str = MODEL, ids: str = "token_ids") -> DataFrame:
    """rows with decoded_text: the text of each list of ids; null for null."""
    key, pieces = _sent(rows.sparkSession, path)
    rows = rows.drop("decoded_text")

    def run(batches):
        automaton = _automaton(key, pieces)
        for batch in batches:
            text = [None if x is None else automaton.decode(x) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(text, pa.string())], names=[*batch.schema.names, "decoded_text"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("decoded_text", T.StringType())]))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_tokens", "token_ids", "round_trip")
