"""Language identification by a bidirectional gated recurrent network over bytes, trained in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwork.llm.common import map_texts, query, table

UNKNOWN = "und"
#: Bytes that one run of the network reads; a text is cut into such spans and every span is read.
SPAN = 64
#: Different labelled texts per language that training reads at most, and spans taken from each.
SAMPLE_ROWS, SAMPLE_SPANS = 800, 6
#: Spans of one step of prediction.
BLOCK = 4096
LETTER = regex.compile(r"\p{L}")


@dataclass
class Direction:
    """Input table (256, 3H) with the biases in it, recurrent weights (H, 2H) of the gates and (H, H) of the candidate."""

    table: np.ndarray
    gates: np.ndarray
    state: np.ndarray


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.multiply(x, np.float32(0.5), out=x)
    np.tanh(x, out=x)
    x += np.float32(1)
    x *= np.float32(0.5)
    return x


def _read(d: Direction, x: np.ndarray, mask: np.ndarray | None, order, keep: list | None = None) -> np.ndarray:
    """States (length, H) of each span for bytes x (length, spans); masked positions leave the state at 0."""
    hidden = d.state.shape[0]
    h = np.zeros((x.shape[1], hidden), dtype=np.float32)
    out = np.empty((x.shape[0], x.shape[1], hidden), dtype=np.float32)
    for t in order:
        inputs = np.take(d.table, x[t], axis=0)
        zr = _sigmoid(inputs[:, : 2 * hidden] + h @ d.gates)
        z, r = zr[:, :hidden], zr[:, hidden:]
        rh = r * h
        c = np.tanh(inputs[:, 2 * hidden :] + rh @ d.state)
        new = h + z * (c - h)
        if mask is not None:
            new *= mask[t][:, None]
        if keep is not None:
            keep.append((t, h, z, r, c, rh))
        h = out[t] = new
    return out


def _back(d: Direction, x: np.ndarray, mask: np.ndarray, kept: list, d_out: np.ndarray) -> Direction:
    """Gradients of one direction by backpropagation through time."""
    grad = Direction(*(np.zeros_like(a) for a in (d.table, d.gates, d.state)))
    hidden = d.state.shape[0]
    dh = np.zeros(d_out.shape[1:], dtype=np.float32)
    for t, h, z, r, c, rh in reversed(kept):
        dn = (dh + d_out[t]) * mask[t][:, None]
        dc = dn * z * (1 - c * c)
        dz = dn * (c - h) * z * (1 - z)
        drh = dc @ d.state.T
        dr = drh * h * r * (1 - r)
        dzr = np.concatenate([dz, dr], axis=1)
        grad.state += rh.T @ dc
        grad.gates += h.T @ dzr
        np.add.at(grad.table, x[t], np.concatenate([dzr, dc], axis=1))
        dh = dn * (1 - z) + drh * r + dzr @ d.gates.T
    return grad


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class ByteGru:
    """Labels every byte position with a language; parameters are float32 arrays."""

    def __init__(self, languages: list[str], hidden: int = 12, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.languages = languages

        def make():
            table = rng.normal(0, 0.5, (256, 3 * hidden))
            table[:, :hidden] -= 1  # gates start slow
            scale = 1 / np.sqrt(hidden)
            return Direction(*(a.astype(np.float32) for a in (
                table, rng.normal(0, scale, (hidden, 2 * hidden)), rng.normal(0, scale, (hidden, hidden)))))

        self.forth, self.back = make(), make()
        self.out = rng.normal(0, 0.3, (2 * hidden, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), dtype=np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [a for d in (self.forth, self.back) for a in (d.table, d.gates, d.state)] + [self.out, self.bias]

    def gradients(self, x: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy over the positions, and its gradient for every parameter."""
        forth, back = [], []
        states = np.concatenate(
            [_read(self.forth, x, mask, range(len(x)), forth), _read(self.back, x, mask, range(len(x) - 1, -1, -1), back)], axis=2
        )
        p = _softmax(states @ self.out + self.bias)
        total, spans = mask.sum(), np.arange(x.shape[1])
        loss = -(np.log(p[:, spans, label] + 1e-9) * mask).sum() / total
        p[:, spans, label] -= 1
        p *= (mask / total)[:, :, None]
        flat = p.reshape(-1, p.shape[2])
        d_out, d_bias = states.reshape(len(flat), -1).T @ flat, flat.sum(axis=0)
        d_states = p @ self.out.T
        hidden = self.forth.state.shape[0]
        a = _back(self.forth, x, mask, forth, d_states[:, :, :hidden])
        b = _back(self.back, x, mask, back, d_states[:, :, hidden:])
        return loss, [a.table, a.gates, a.state, b.table, b.gates, b.state, d_out, d_bias]

    def train(self, spans: list[bytes], labels: np.ndarray, steps: int = 500, batch: int = 128, rate: float = 0.01, seed: int = 5):
        """Adam on random batches."""
        rng = np.random.default_rng(seed)
        first = [np.zeros_like(a) for a in self.parameters()]
        second = [np.zeros_like(a) for a in self.parameters()]
        x, mask = pad(spans)
        for step in range(1, steps + 1):
            pick = rng.integers(0, len(spans), batch)
            _, grads = self.gradients(x[:, pick], mask[:, pick], labels[pick])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            scale = min(1.0, 1.0 / (norm + 1e-9))
            pace = rate * (1 - 0.9 * step / steps)
            for a, g, m, v in zip(self.parameters(), grads, first, second):
                g = g * scale
                m *= 0.9
                m += 0.1 * g
                v *= 0.99
                v += 0.01 * g * g
                a -= (pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return self

    def span_sums(self, spans: list[bytes]) -> np.ndarray:
        """Sum over each span's positions of the language probabilities."""
        out = np.zeros((len(spans), len(self.languages)))
        for at in range(0, len(spans), BLOCK):
            x, mask = pad(spans[at : at + BLOCK])
            padded = None if mask.all() else mask
            hidden = self.forth.state.shape[0]
            forth = _read(self.forth, x, padded, range(len(x))).reshape(-1, hidden)
            back = _read(self.back, x, padded, range(len(x) - 1, -1, -1)).reshape(-1, hidden)
            p = self.out[:hidden].T @ forth.T + self.out[hidden:].T @ back.T + self.bias[:, None]  # languages first
            np.exp(p - p.max(axis=0), out=p)
            p *= mask.reshape(-1) / p.sum(axis=0)
            out[at : at + BLOCK] = p.reshape(len(p), *mask.shape).sum(axis=1).T
        return out

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """(language, pooled probability) of whole texts; `und` with score 0 for texts without a letter."""
        data = [t.encode() if LETTER.search(t) else b"" for t in texts]
        spans = [d[i : i + SPAN] for d in data for i in range(0, len(d), SPAN)]
        owner = np.repeat(np.arange(len(data)), [-(-len(d) // SPAN) for d in data])
        sums = np.zeros((len(data), len(self.languages)))
        for at in range(0, len(spans), BLOCK):
            np.add.at(sums, owner[at : at + BLOCK], self.span_sums(spans[at : at + BLOCK]))
        best = sums.argmax(axis=1)
        return [
            (self.languages[b], float(min(1.0, s[b] / len(d)))) if d else (UNKNOWN, 0.0) for d, s, b in zip(data, sums, best)
        ]


def pad(spans: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes (SPAN, spans) and the mask of those that exist."""
    joined = b"".join(s.ljust(SPAN, b"\0") for s in spans)
    lengths = np.fromiter(map(len, spans), dtype=np.int64, count=len(spans))
    mask = np.arange(SPAN)[:, None] < lengths[None, :]
    return np.ascontiguousarray(np.frombuffer(joined, np.uint8).reshape(-1, SPAN).T), mask.astype(np.float32)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def sample(df: DataFrame, label: str = "lang", text: str = "text", rows: int = SAMPLE_ROWS, per_text: int = SAMPLE_SPANS) -> DataFrame | None:
    """(l, parts): spans of at most `rows` different texts of each label, those with the smallest hashes; None without labels.

    A text counts once for its label, however many copies it has. Texts are told apart by two 64-bit hashes, so only
    hashes are counted and ranked. About twice the wanted number passes the draw, and the rank sees no others.
    """
    usable = df.filter(F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.col(label).alias("l"), F.col(text).alias("t"), F.xxhash64(F.lit(11), text).alias("h1"), F.xxhash64(F.lit(12), text).alias("h2")
    )
    counts = {r["l"]: r["count"] for r in usable.select("l", "h1", "h2").distinct().groupBy("l").count().collect()}
    if not counts:
        return None
    share = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(1.0, (2 * rows + 100) / n))))
    draw = F.pmod("h1", F.lit(1_000_000_000)) / 1_000_000_000
    step = F.greatest(F.lit(1), F.floor(F.char_length("t") / per_text)).cast("int")
    parts = F.array(*(F.substring("t", F.lit(1) + step * i, F.lit(SPAN)) for i in range(per_text)))
    drawn = usable.filter(draw < share[F.col("l")]).select("l", "h1", "h2", draw.alias("draw"), parts.alias("parts"))
    drawn = drawn.groupBy("l", "h1", "h2").agg(F.min("draw").alias("draw"), F.min("parts").alias("parts"))  # copies are alike
    rank = F.row_number().over(Window.partitionBy("l").orderBy("draw", "h1", "h2"))
    return drawn.withColumn("rank", rank).filter(F.col("rank") <= rows).select("l", "parts")


def learn(df: DataFrame, label: str = "lang", text: str = "text", rows: int = SAMPLE_ROWS, per_text: int = SAMPLE_SPANS) -> ByteGru | None:
    """Network trained on at most `rows` different texts of each label and `per_text` spans of each; None without labels.

    Texts are chosen by a hash, so the same table gives the same model.
    """
    found = sample(df, label, text, rows, per_text)
    if found is None:
        return None
    chosen, pairs = found.toPandas(), []
    languages = sorted(set(chosen["l"]))
    for lang, texts in zip(chosen["l"], chosen["parts"]):
        pairs += [(t.encode()[:SPAN], lang) for t in texts if LETTER.search(t)]
    if not pairs:
        return None
    pairs.sort()
    number = {lang: i for i, lang in enumerate(languages)}
    return ByteGru(languages).train([p for p, _ in pairs], np.array([number[lang] for _, lang in pairs]))


def identify(df: DataFrame, model: ByteGru | None, text: str = "text") -> DataFrame:
    """Adds lang_pred and score to every row; other columns stay. Without a model every text is `und`."""
    df = df.drop("lang_pred", "score")

    def work(texts: list[str]) -> list[pa.Array]:
        found = model.predict(texts) if model else [(UNKNOWN, 0.0)] * len(texts)
        return [pa.array([x[0] for x in found], pa.string()), pa.array([float(x[1]) for x in found], pa.float64())]

    return map_texts(df, text, df.columns, work, "lang_pred string, score double")


def train_on(docs: DataFrame) -> ByteGru | None:
    return learn(docs.filter(~held_out(F.col("doc_id"))))


@query("op8_language_id")
def op8_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), train_on(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
