"""Hash choices and network outputs recomputed without Spark and without matrices."""

import math
import re
import struct

import numpy as np
import xxhash

from tillwork.llm import language_id, order_minhash
from tillwork.llm.queries import QUERIES
from pyspark.sql import functions as F


def chained(*values):
    """Hash of several columns: each value's XXH64 seeds the next, a null changes nothing. Integers are given as (value, bytes)."""
    seed = 42
    for v in values:
        if v is not None:
            data = v.encode() if isinstance(v, str) else struct.pack("<q" if v[1] == 8 else "<i", v[0])
            seed = xxhash.xxh64_intdigest(data, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def shard_of(key, shards):
    def score(i):
        bits = (chained(None if key is None else (key, 8), (i, 4)) % (1 << 64)) >> 11
        return -1.0 / math.log((bits + 0.5) / 2.0**53)

    return max(range(shards), key=lambda i: (score(i), -i))


def test_shards_of_keys(spark, docs_dir):
    got = QUERIES["op1_rendezvous_shards"](spark, docs_dir).collect()
    assert all((r.shard, r.grown_shard) == (shard_of(r.doc_id, 40), shard_of(r.doc_id, 41)) for r in got)


def fingerprint(text, k=3, places=64, pick=2):
    tokens = re.findall(r"[^ \t\n\x0b\f\r]{1,12}", text)
    grams, seen, dealt = [], {}, {}
    for p in range(max(len(tokens) - k + 1, 1) if tokens else 0):
        g = chained(*(tokens[p + j] if p + j < len(tokens) else None for j in range(k)))
        grams.append((g, p))
    for g, p in sorted(grams):
        number = seen[g] = seen.get(g, -1) + 1
        dealt.setdefault(chained((g, 8), (number, 4)) % places, []).append((chained((number, 4), (g, 8)), g, p))
    out = []
    for b in range(places):
        chosen = sorted((p, g) for _, g, p in sorted(dealt.get(b, []))[:pick])
        out.append(f"{chained(*((g, 8) for _, g in chosen)) % (1 << 64):016x}"[-8:] if chosen else "-" * 8)
    return "".join(out)


def test_fingerprints(spark, rows):
    texts = [d[1] for d in rows if d[1] and len(d[1]) < 6000 and " " not in d[1]] + ["", "one", "a b", "x x x x x x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = order_minhash.with_fingerprint(df, F.col("t"), "f").collect()
    assert all(r.f == fingerprint(r.t) for r in got)
    a, b = fingerprint(texts[8]), fingerprint(texts[8] + " more words at the end")
    cells = [(a[i : i + 8], b[i : i + 8]) for i in range(0, 512, 8)]
    filled = [c for c in cells if c != ("-" * 8, "-" * 8)]
    pair = spark.createDataFrame([(a, b)], "a string, b string")
    assert pair.select(order_minhash.likeness(F.col("a"), F.col("b"))).first()[0] == sum(x == y for x, y in filled) / len(filled)


def plain_probabilities(model, span):
    """Language probabilities of every byte of a span, one byte and one unit at a time."""

    def read(d, data):
        hidden, out = d.state.shape[0], []
        h = [0.0] * hidden
        for byte in data:
            row = [float(v) for v in d.table[byte]]
            gate = [1 / (1 + math.exp(-(row[j] + sum(h[i] * float(d.gates[i, j]) for i in range(hidden))))) for j in range(2 * hidden)]
            z, r = gate[:hidden], gate[hidden:]
            c = [math.tanh(row[2 * hidden + j] + sum(r[i] * h[i] * float(d.state[i, j]) for i in range(hidden))) for j in range(hidden)]
            h = [h[j] + z[j] * (c[j] - h[j]) for j in range(hidden)]
            out.append(h)
        return out

    forth, back = read(model.forth, span), read(model.back, span[::-1])[::-1]
    for f, b in zip(forth, back):
        logits = [float(model.bias[k]) + sum(v * float(model.out[i, k]) for i, v in enumerate(f + b)) for k in range(len(model.languages))]
        e = [math.exp(v - max(logits)) for v in logits]
        yield [v / sum(e) for v in e]


def test_predictions_of_the_network():
    model = language_id.ByteGru(["de", "en", "fr"])
    texts = ["Grüße aus Köln, und noch viel mehr Text als in einen Abschnitt paßt, damit es zwei werden.", "short", "é", "12 34", ""]
    for text, (lang, score) in zip(texts, model.predict(texts)):
        data = text.encode()
        if not any(c.isalpha() for c in text):
            assert (lang, score) == ("und", 0.0)
            continue
        spans = [data[i : i + language_id.SPAN] for i in range(0, len(data), language_id.SPAN)]
        pooled = np.mean([p for s in spans for p in plain_probabilities(model, s)], axis=0)
        assert lang == model.languages[pooled.argmax()] and abs(score - pooled.max()) < 1e-4
