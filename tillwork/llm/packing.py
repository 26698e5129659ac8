"""Cost-balanced packing of token ids into sequences of fixed room."""

from __future__ import annotations

import heapq
import json
import string
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.common import map_texts, query, table

#: Text bytes that one packing cell holds on average.
CELL_BYTES = 4_000_000
#: Sequence numbers reserved for one cell.
CELL_ROOM = 1 << 24
#: Words of one generation, of which a Python worker keeps two: about 35 MB with the tokenizer (400,000: 86 MB, which
#: took the pipeline's executors past 3000 MB in packing); misses cost about 40 % more time in tokenising.
CACHE_SIZE = 100_000
#: Texts whose words are looked up together.
TEXTS = 256
#: Marks that often end a run.
MARKS = ".,;:!?"


class WordIds(dict):
    """Ids of a run of non-space bytes in little-endian integers of the vocabulary's width, remembered.

    The tokenizer drops white space and never merges across it, so a text's ids are those of its runs. Where it also
    ignores ASCII case and splits before punctuation (tried on its own normaliser and splitter), a run of ASCII letters,
    with or without a mark behind it, is merged by a rank encoder built from the same merges, which is faster on new
    words; all other runs go through the tokenizer itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.width = "<u2" if self.model.get_vocab_size() <= 65536 else "<u4"
        self.marks = {c.encode(): self._encode(c.encode()) for c in MARKS}
        self.letters, self.ids, self.last = self._rank_encoder()
        self.former: dict[bytes, bytes] = {}

    def _rank_encoder(self):
        """Encoder of lower-case ASCII words with the last letter in upper case, ids by rank, ranks that end a word; or None."""
        normal, splitter, spec = self.model.normalizer, self.model.pre_tokenizer, json.loads(self.model.to_str())["model"]
        parts = [splitter.pre_tokenize_str(f"ab{c}") for c in MARKS] if splitter is not None else [()]
        splits = all(len(p) == 2 and p[0] == ("ab", (0, 2)) for p in parts)
        end = spec.get("end_of_word_suffix")
        if not (splits and end and spec["type"] == "BPE" and normal is not None and normal.normalize_str("AbZ") == "abz"):
            return None, None, None
        ranks, ids = {}, []

        def add(token: str):
            last = token.endswith(end)
            word = token.removesuffix(end)
            if word.isascii() and word.isalpha() and word.islower() and token in spec["vocab"]:
                key = (word[:-1] + word[-1].upper() if last else word).encode()
                if key not in ranks:
                    ranks[key] = len(ids)
                    ids.append(spec["vocab"][token])

        for letter in string.ascii_lowercase:
            add(letter)
            add(letter + end)
        if len(ids) != 52:
            return None, None, None
        for merge in spec["merges"]:
            add("".join(merge.split(" ") if isinstance(merge, str) else merge))
        encoder = tiktoken.Encoding("letters", pat_str="[A-Za-z]+", mergeable_ranks=ranks, special_tokens={})
        last = np.array([key[-1:].isupper() for key in ranks])
        return encoder.encode_ordinary, np.array(ids, dtype=self.width), last

    def learn(self, words: set[bytes]) -> None:
        """Two generations: when the younger is full it becomes the former one, from which words in use come back."""
        new = [w for w in words if w not in self]
        if len(self) + len(new) > CACHE_SIZE:
            self.former = dict(self)
            self.clear()
            new = list(words)
        if self.former:
            known = self.former
            self.update([(w, known[w]) for w in new if w in known])
            new = [w for w in new if w not in known]
        plain = []
        for word in new:
            tail = self.marks.get(word[-1:], b"")
            letters = word[:-1] if tail else word
            if self.letters is not None and letters.isalpha():  # bytes: ASCII letters only
                plain.append((word, letters.lower(), tail))
            else:
                self[word] = self._encode(word)
        if plain:
            ranks = np.array(self.letters(b" ".join([w[:-1] + w[-1:].upper() for _, w, _ in plain]).decode()))
            ids, size, at = self.ids[ranks].tobytes(), self.ids.itemsize, 0
            for (word, _, tail), end in zip(plain, (np.flatnonzero(self.last[ranks]) + 1).tolist()):
                self[word] = ids[at * size : end * size] + tail
                at = end

    def _encode(self, word: bytes) -> bytes:
        return np.asarray(self.model.encode(word.decode(), add_special_tokens=False).ids, dtype=self.width).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text; new words are learnt for a block of texts at a time."""
        out = []
        for at in range(0, len(texts), TEXTS):
            split = [t.encode().split() for t in texts[at : at + TEXTS]]  # bytes: ASCII white space only
            self.learn(set().union(*split))
            out += [b"".join(map(self.__getitem__, words)) for words in split]
        return out


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


class Cheapest:
    """Sequences by remaining room: a heap of (cost, sequence) for every room, under a tree of the heaps' smallest entries."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << room.bit_length()
        self.heaps = [[] for _ in range(room + 1)]
        self.least: list[tuple[float, int] | None] = [None] * (2 * self.leaves)
        self.heaps[room] = [(0.0, b) for b in range(bins)]  # in order, so a heap
        self._mend(room)

    def _mend(self, space: int) -> None:
        least, at = self.least, self.leaves + space
        least[at] = self.heaps[space][0] if self.heaps[space] else None
        while at > 1:
            at >>= 1
            a, b = least[2 * at], least[2 * at + 1]
            least[at] = b if a is None or b is not None and b < a else a

    def push(self, space: int, entry: tuple[float, int]) -> None:
        if space:  # a full sequence takes nothing more
            heapq.heappush(self.heaps[space], entry)
            self._mend(space)

    def pop(self, size: int) -> tuple[float, int] | None:
        """Takes out the sequence of the lowest cost among all with room for `size`; None if there is none."""
        least, at = self.least, self.leaves + size
        best, node = least[at], at
        while at > 1:
            if at % 2 == 0 and least[at + 1] is not None and (best is None or least[at + 1] < best):
                best, node = least[at + 1], at + 1
            at >>= 1
        if best is None:
            return None
        while node < self.leaves:
            node = 2 * node if least[2 * node] == best else 2 * node + 1
        heapq.heappop(self.heaps[node - self.leaves])
        self._mend(node - self.leaves)
        return best


def pack(lengths: list[int], room: int, quadratic: float) -> list[tuple[int, int, int, int]]:
    """Pieces (document, start, length, sequence) in sequences of at most `room`.

    Documents of at least `room` ids fill whole sequences; what is left goes, longest first, to the sequence of the
    lowest cost (linear plus quadratic in a piece's length) that can take all of it, among as few sequences as hold
    the sum. What fits nowhere is cut over the roomiest ones, so only one sequence's worth of padding is left.
    """
    pieces, left, n = [], [], 0
    for i, length in enumerate(lengths):
        full = length // room
        pieces += [(i, k * room, room, n + k) for k in range(full)]
        n += full
        if length % room:
            left.append((-(length % room), i, full * room))
    bins = -(-sum(-x[0] for x in left) // room)
    free = [room] * bins
    cheapest = Cheapest(bins, room)
    uncut = []
    for size, i, start in sorted(left):
        size, found = -size, cheapest.pop(-size)
        if found is None:  # room only shrinks from here on, so it will not fit later either
            uncut.append((size, i, start))
            continue
        cost, chosen = found
        free[chosen] -= size
        cheapest.push(free[chosen], (cost + size + quadratic * size * size, chosen))
        pieces.append((i, start, size, n + chosen))
    open_bins = [(-f, b) for b, f in enumerate(free) if f]
    heapq.heapify(open_bins)
    for size, i, start in uncut:
        while size:
            space, b = heapq.heappop(open_bins)
            take = min(size, -space)
            pieces.append((i, start, take, n + b))
            size, start = size - take, start + take
            if take < -space:
                heapq.heappush(open_bins, (space + take, b))
    return pieces


def pack_documents(
    df: DataFrame, path: str, room: int = 2048, end_id: int = 1, quadratic: float = 1 / 2048, text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """(keep, start, length, ids, doc_tokens, sequence_id, offset), one row per piece.

    Documents are tokenised where they lie and dealt by a hash of their row to cells of about CELL_BYTES of text,
    however large the input or its groups are; each cell is packed by itself and leaves less than one sequence of
    padding. Rows are told apart by their place in `df`, which has to be a stored table, so that a task that runs again
    finds them at the same place. A null or empty text is its end id alone. Repeated rows are packed each. A document is never
    split between cells.
    """
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    cells = max(1, -(-size // CELL_BYTES))
    kinds = dict(df.dtypes)
    head = [f"_{i}" for i in range(len(keep))]
    kept = ", ".join(f"{h} {kinds[c]}" for c, h in zip(keep, head))

    def tokenise(texts: list[str]) -> list[pa.Array]:
        words = word_ids(path)
        end = np.array([end_id], dtype=words.width).tobytes()
        return [pa.array([x + end for x in words.encode(texts)], pa.binary())]

    def place(group: pa.Table) -> pa.Table:
        width = word_ids(path).width
        group = group.take(pc.sort_indices(group, sort_keys=[("_row", "ascending")]))
        ids = [np.frombuffer(b, width).astype("<u4") for b in group.column("ids").to_pylist()]
        base, rows, filled = group.column("_cell")[0].as_py() * CELL_ROOM, [], {}
        for i, start, length, sequence in pack([len(x) for x in ids], room, quadratic):
            offset = filled.get(sequence, 0)
            filled[sequence] = offset + length
            rows.append((i, start, length, ids[i][start : start + length].tobytes(), len(ids[i]), base + sequence, offset))
        at, starts, lengths, pieces, sizes, sequences, offsets = zip(*rows)
        whole = [pa.array(x, pa.int64()) for x in (starts, lengths, sizes, sequences, offsets)]
        columns = [group.column(h).take(pa.array(at, pa.int64())) for h in head]
        return pa.table([*columns, whole[0], whole[1], pa.array(pieces, pa.binary()), *whole[2:]], [*head, *made])

    made = ["start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    rows = df.select(*(F.col(c).alias(h) for c, h in zip(keep, head)), F.col(text).alias("_text"), F.monotonically_increasing_id().alias("_row"))
    rows = rows.withColumn("_cell", F.pmod(F.xxhash64("_row"), F.lit(cells)))
    coded = map_texts(rows, "_text", [*head, "_row", "_cell"], tokenise, "ids binary")
    packed = coded.groupBy("_cell").applyInArrow(
        place, ", ".join([*([kept] if kept else []), *(f"{n} {'binary' if n == 'ids' else 'long'}" for n in made)])
    )
    return packed.toDF(*keep, *made)


def packed_digest(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op6_packing")
def op6_packing(spark, sf_dir: str) -> DataFrame:
    return packed_digest(table(spark, sf_dir, "documents").select("doc_id", "text"))
