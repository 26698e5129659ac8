"""Every operator against a brute-force version on small tables with the odd cases."""

import base64
import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import public_tokenizers
from tillwork.llm import language_id, license_scan, order_minhash, packing, substring_dedup, vector_dedup
from tillwork.llm.common import components
from tillwork.llm.queries import QUERIES
from tillwork.llm.sharding import rendezvous_shard

SPACE = re.compile("[\x20\x09-\x0d]+")


def words_of(text):
    return [w for w in SPACE.split(text or "") if w]


def as_bag(pairs):
    return Counter(pairs)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).count() == 0


def test_sharding(spark, docs_dir, rows):
    got = QUERIES["op1_rendezvous_shards"](spark, docs_dir).collect()
    assert as_bag((r.doc_id, r.size, r.text_crc32) for r in got) == as_bag(
        (d[0], len((d[1] or "").encode()) + 16, zlib.crc32((d[1] or "").encode())) for d in rows
    )
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shard_weights(spark):
    df = spark.range(20000).select(rendezvous_shard(F.col("id"), [1, 3, 0, 2]).alias("s")).groupBy("s").count()
    counts = {r.s: r["count"] for r in df.collect()}
    assert set(counts) == {0, 1, 3}
    assert abs(counts[1] / 20000 - 0.5) < 0.02 and abs(counts[3] / 20000 - 1 / 3) < 0.02
    with pytest.raises(ValueError):
        rendezvous_shard(F.col("id"), [0.0])


def test_order_minhash(spark, docs_dir, rows):
    got = QUERIES["op2_order_minhash"](spark, docs_dir).collect()
    assert len(got) == len(rows)
    by_text, ids = {}, [d for d in rows if d[0] is not None]
    unique = sorted({d[0]: d[1] or "" for d in ids}.items(), reverse=True)
    texts = dict(unique)
    for r in got:
        if r.doc_id is None or r.doc_id == rows[20][0]:
            continue
        text = texts[r.doc_id]
        assert r.n_chars == len(text) and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        at = [i for i, _ in unique].index(r.doc_id)
        if at + 1 < len(unique):  # the smallest id is followed by the rows without one
            half, after = len(text) // 2, unique[at + 1][1]
            edited = text[: len(text) - half] + after[:half]
            assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()


def test_next_wraps_around(spark):
    df = spark.createDataFrame([(i * 7 % 501, f"t{i * 7 % 501}") for i in range(501)], "k long, t string")
    got = {r.k: r["next"].t for r in order_minhash.with_next(df, "k", ["t"], rows_per_part=20).collect()}
    assert got == {k: f"t{(k - 1) % 501}" for k in range(501)}


def test_order_sensitive(spark):
    base = [f"w{i}" for i in range(400)]
    swapped, edited = base[200:] + base[:200], base[:390] + ["new"] * 10
    df = spark.createDataFrame([(" ".join(base), " ".join(swapped), " ".join(edited))], "a string, b string, c string")
    for c in "abc":
        df = order_minhash.with_fingerprint(df, F.col(c), f"f{c}")
    r = df.select(*(order_minhash.likeness(F.col("fa"), F.col(f)).alias(f) for f in ("fa", "fb", "fc"))).first()
    assert r.fa == 1 and r.fb < r.fc and r.fc > 0.7


def test_license_scan(spark, docs_dir, rows):
    got = QUERIES["op3_license_scan"](spark, docs_dir).collect()
    expect = []
    for d in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in d[1] or "")
        words = re.findall(license_scan.WORD, low)
        starts = [
            (i, label) for p, label in license_scan.PHRASES.items() for i in range(len(words))
            if words[i : i + len(p.split())] == p.split()
        ]
        base, extra, score = {x for _, x in starts}, set(), float(bool(starts))
        for line in low.split("\n"):
            have = set(re.findall(license_scan.WORD, line))
            for label, t in license_scan.TEMPLATES.items():
                need = set(t.split())
                part = len(have & need) / len(need)
                if part >= 0.8:
                    extra.add(label)
                    score = max(score, part)
        places = [i for i, _ in starts]
        expect.append((d[0], len(words), len(starts), min(places, default=None), max(places, default=None),
                       ",".join(sorted(base)), ",".join(sorted(base | extra)), score))
    assert as_bag(map(tuple, got)) == as_bag(expect)
    assert any("mit" in r.labels for r in got)


def test_licenses_wrapped_and_in_long_lines(spark):
    """Windows of twice a template's words, wherever lines break, against every window of every text."""
    rng = random.Random(4)
    bsd = "Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that"
    gpl = "# you can redistribute it and/or modify\n# it under the terms of the GNU General Public\n# License as published"
    spread = license_scan.TEMPLATES["public-domain"].split()[:8]
    filler = [f"f{i}" for i in range(50)] + ["the", "of", "and", "in", "license", "public", "software", "under"]

    def prose(n):
        return [rng.choice(filler) for _ in range(n)]

    long = prose(20000)
    for i, w in enumerate(spread):
        long[1000 + 2400 * i] = w
    texts = [bsd, gpl, " ".join(long), "", None, "permission"]
    for label, t in license_scan.TEMPLATES.items():
        for extra in (0, 3, 9, 30):
            words = t.split()
            for _ in range(extra):
                words.insert(rng.randint(1, len(words) - 1), "x")
            if rng.random() < 0.5:
                del words[rng.randrange(len(words))]
            texts.append(rng.choice([" ", "\n"]).join(prose(rng.randint(0, 200)) + words + prose(rng.randint(0, 200))))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string").repartition(3)
    got = {r.i: (set(r.template_labels), r.score if not r.places else None) for r in license_scan.scan_licenses(df).collect()}
    for i, text in enumerate(texts):
        words = re.findall(license_scan.WORD, (text or "").lower())
        labels, score = set(), 0.0
        for label, t in license_scan.TEMPLATES.items():
            need, span = set(t.split()), 2 * len(t.split())
            part = max(len(need & set(words[k : k + span])) for k in range(max(1, len(words) - span + 1))) / len(need)
            if part >= 0.8:
                labels.add(label)
                score = max(score, part)
        assert got[i][0] == labels and got[i][1] in (None, score)
    assert got[0][0] == {"bsd"} and got[1][0] == {"gpl"} and got[2][0] == set()


def test_containment_join_is_exact(spark):
    rng = random.Random(3)
    vocabulary = [f"v{i}" for i in range(30)]
    templates = {f"t{i}": " ".join(rng.sample(vocabulary, rng.randint(1, 12))) for i in range(12)}
    blocks = [(i, 0, rng.sample(vocabulary, rng.randint(0, 28))) for i in range(300)]
    df = spark.createDataFrame(blocks, "_row int, _block int, words array<string>")
    got = {(r._row, r.label) for r in license_scan.containment_join(df, templates, 0.7).collect()}
    assert got == {
        (i, label) for i, _, w in blocks for label, t in templates.items()
        if len(set(w) & set(t.split())) >= 0.7 * len(set(t.split())) - 1e-9
    }


def test_url_filter(spark, tmp_path):
    urls = [
        None, "", "no scheme", "http://a.NET/x?y", "http://a.net", "https://Example.net/en/1#t", "https://m.example.net/en",
        "http://badexample.com/de/1", "http://x.example.com/de/1", "http://x.org/fr/9", "http://x.org/de/9", "://net/",
        "http://cheap-pills.example.org/en/", "http://www.cheap-pills.example.net/en/2", "http://net/", "x\n://a.net/é",
        "http://spam-farm.org/fr/2", "http://u@a.net:80/en/", "http://a.net/en/",
    ]
    rows = [(i, u, "e", "f") for i, u in enumerate(urls)] + [(3, urls[3], "e", "f")]
    spark.createDataFrame(rows, "page_id long, url string, rule string, host string").write.parquet(f"{tmp_path}/pages.parquet")
    got = QUERIES["op4_url_filter"](spark, str(tmp_path)).collect()
    expect = []
    for i, u, *_ in rows:
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [
            n for n in ("example.net/en/", "example.com/de/", "org/fr/", "net/")
            if (host == n.split("/")[0] or host.endswith("." + n.split("/")[0])) and path.startswith(n[n.index("/"):])
        ]
        rule = max(fits, key=len, default=None)
        farm = any(f".{x}." in "." + host for x in ("cheap-pills", "spam-farm"))
        verdict = ("allow" if rule in ("example.net/en/", "org/fr/") else "block") if rule else "block" if farm else "allow"
        expect.append((i, host, path, rule, verdict))
    assert as_bag(map(tuple, got)) == as_bag(expect)


def test_byte_bpe(spark, docs_dir, rows):
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expect = []
    for d in rows:
        ids = coder.encode_ordinary(d[1] or "")
        expect.append((d[0], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                       hashlib.sha256((d[1] or "").encode()).hexdigest()))
    assert as_bag(map(tuple, QUERIES["op5_byte_bpe"](spark, docs_dir).collect())) == as_bag(expect)


def test_packing(spark, docs_dir, rows):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = spark.read.parquet(f"{docs_dir}/documents.parquet")
    got = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    one_id = {d[0]: model.encode(d[1] or "", add_special_tokens=False).ids + [1] for d in rows if d[0] is not None}
    parts, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
        if r.doc_id is not None and r.doc_id != rows[20][0]:
            parts[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
            assert r.doc_tokens == len(one_id[r.doc_id]) and r.length == len(r.ids) // 4
    for i, pieces in parts.items():
        assert [x for s, p in sorted(pieces) for x in p] == one_id[i]
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in got)
    assert len(sequences) == math.ceil(total / 2048)  # one cell: less than one sequence of padding


def test_pack_cuts_what_does_not_fit():
    pieces = packing.pack([60, 60, 60, 60, 60], 100, 0.01)
    assert len({p[3] for p in pieces}) == 3 and sum(p[2] for p in pieces) == 300


def test_pack_finds_the_cheapest_sequence_with_room():
    """Every whole piece against a search of all sequences; only what fits nowhere is cut."""
    rng = random.Random(6)
    lengths = [rng.randint(1400, 2000) for _ in range(250)] + [rng.randint(1, 120) for _ in range(9000)]
    room, quadratic = 2048, 1 / 2048
    bins = -(-sum(lengths) // room)
    assert bins > 250
    free, cost, expect, cut = [room] * bins, [0.0] * bins, {}, set()
    for size, i in sorted((-x, i) for i, x in enumerate(lengths)):
        fits = [(cost[b], b) for b in range(bins) if free[b] >= -size]
        if not fits:
            cut.add(i)
            continue
        c, b = min(fits)
        free[b], cost[b], expect[i] = free[b] + size, c - size + quadratic * size * size, b
    pieces = packing.pack(lengths, room, quadratic)
    whole = {i: b for i, _, size, b in pieces if size == lengths[i] and i not in cut}
    assert whole == expect and sum(p[2] for p in pieces) == sum(lengths)


def vectors():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((150, 16))
    for c in range(6):
        x = np.vstack([x, x[c] + rng.standard_normal((25, 16)) * rng.uniform(0.02, 0.2)])
    rows = [(2 * i + 5, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    rows += [(1, rows[0][1]), (9001, rows[0][1]), (9002, [2 * v for v in rows[0][1]])]
    rows += [(9003, None), (9004, [0.0] * 16), (9005, [float("nan")] * 16), (9006, [None] * 16), (9007, []), (9008, [1.0, 2.0])]
    rows += [(9009, [float("inf")] + [1.0] * 15)]
    return rows


@pytest.mark.parametrize("block", [512, 7])
def test_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(vector_dedup, "BLOCK", block)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component) for r in vector_dedup.near_vectors(df).collect()}
    assert len(got) == len(rows)
    good = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if v and len(v) == 16 and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    x = np.array([v / np.linalg.norm(v) for _, v in good])
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    wanted, found = near.sum(), sum(got[i][0] for i, _ in good)
    assert 0.95 * wanted <= found <= wanted
    low = vector_dedup._labels(near | np.eye(len(good), dtype=bool), np.array([i for i, _ in good]))
    same = sum(got[i][1] == c for (i, _), c in zip(good, low))
    assert same >= 0.95 * len(good)
    names = {i for i, _ in good}
    assert all(got[i] == (0, i) for i, _ in rows if i not in names)


def test_language_gradients():
    model = language_id.ByteGru(["a", "b"], hidden=3)
    for d in (model.forth, model.back):
        d.table, d.gates, d.state = (a.astype(np.float64) for a in (d.table, d.gates, d.state))
    x, mask = language_id.pad([b"hello wor", b"xyz"])
    x, mask, label = x[:10], mask[:10], np.array([0, 1])
    _, grads = model.gradients(x, mask, label)
    for a, g in zip(model.parameters(), grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, step = a[at], 1e-2
        a[at] = old + step
        up = model.gradients(x, mask, label)[0]
        a[at] = old - step
        down = model.gradients(x, mask, label)[0]
        a[at] = old
        assert abs((up - down) / (2 * step) - g[at]) < 2e-3 + 0.02 * abs(g[at])


def test_language_network_has_its_full_size():
    model = language_id.ByteGru(["a", "b", "c"])
    assert model.forth.state.shape == model.back.state.shape == (12, 12) and model.out.shape == (24, 3)


def test_language(spark, docs_dir, rows):
    got = QUERIES["op8_language_id"](spark, docs_dir).collect()
    assert as_bag((r.doc_id, r.held_out) for r in got) == as_bag(
        (d[0], d[0] is not None and zlib.crc32(str(d[0]).encode()) % 3 == 1) for d in rows
    )
    none = {d[0] for d in rows if not any(c.isalpha() for c in d[1] or "")}
    assert all((r.lang_pred == "und") == (r.doc_id in none) and 0 <= r.score <= 1 for r in got)


def test_language_sample_counts_a_text_once(spark):
    """Copies neither crowd out the other texts of their language nor come to the driver."""
    rows = [("hot", f"many copies {i % 3}") for i in range(6000)] + [("hot", f"other text {i}") for i in range(300)]
    rows += [("few", f"rare {i}") for i in range(7)] + [("hot", None), (None, "no label"), ("few", "12")]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    drawn = [(r.l, r.parts[0]) for r in language_id.sample(df, rows=50, per_text=1).collect()]
    assert Counter(lang for lang, _ in drawn) == {"hot": 50, "few": 7} and len(set(drawn)) == 57
    assert sum(t.startswith("other") for _, t in drawn) >= 47
    assert sorted(drawn) == sorted((r.l, r.parts[0]) for r in language_id.sample(df.repartition(2), rows=50, per_text=1).collect())
    everything = language_id.sample(df, rows=1000, per_text=1).collect()
    assert len(everything) == 303 + 7


def test_language_learns(spark):
    rng = random.Random(2)
    sounds = {"aa": ["ka", "lo", "mi"], "bb": ["str", "önk", "eß"], "cc": ["ou", "eau", "ç"]}
    rows = [
        (i, " ".join("".join(rng.choices(parts, k=3)) for _ in range(rng.randint(2, 40))), lang)
        for i, (lang, parts) in enumerate(list(sounds.items()) * 60)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language_id.identify(df.drop("lang"), language_id.train_on(df)).collect()
    held = {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    truth = {i: lang for i, _, lang in rows}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in found if r.doc_id in held]) > 0.95


def brute_simhash(text):
    words = words_of("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(nodes, near):
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            m = min(low[b] for b in near[a])
            if m < low[a]:
                low[a], changed = m, True
    return low


def test_simhash(spark, docs_dir, rows):
    got = QUERIES["op9_simhash"](spark, docs_dir).collect()
    prints = {d[1]: brute_simhash(d[1]) for d in rows}
    fps = sorted(set(prints.values()))
    low = linked(fps, {a: [b for b in fps if bin(a ^ b).count("1") <= 2] for a in fps})
    first = {}
    for d in rows:
        c = low[prints[d[1]]]
        if d[0] is not None:
            first[c] = min(first.get(c, d[0]), d[0])
    expect = as_bag((d[0], f"{prints[d[1]]:016x}", first.get(low[prints[d[1]]])) for d in rows)
    assert as_bag(map(tuple, got)) == expect


@pytest.mark.parametrize("crowd", [32, 2])
def test_simhash_links(spark, monkeypatch, crowd):
    from tillwork.llm import simhash

    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(30)}
    for f in list(fps)[:10]:
        for _ in range(25):
            g = f
            for b in rng.sample(range(64), rng.randint(1, 4)):
                g ^= 1 << b
            fps.add(g)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = components(simhash.near_edges(spark.createDataFrame([(f,) for f in signed], "fp long"))).collect()
    near = {a: [b for b in signed if bin((a ^ b) & (2**64 - 1)).count("1") <= 2] for a in signed}
    low = linked(signed, near)
    found = {r.node: r.component for r in got}
    assert all(found.get(f, f) == low[f] for f in signed)


def test_substring_dedup(spark, docs_dir, rows):
    got = QUERIES["op10_substring_dedup"](spark, docs_dir).collect()
    first, texts = {}, {}
    for d in rows:
        texts.setdefault(-1 if d[0] is None else d[0], []).append(d[1])
    for i, many in sorted(texts.items()):
        for t in dict.fromkeys(many):
            w = words_of(t)
            for s in range(len(w) - 19):
                key = tuple(w[s : s + 20])
                first[key] = min(first.get(key, (i, s)), (i, s))
    expect = []
    for d in rows:
        w, i = words_of(d[1]), -1 if d[0] is None else d[0]
        gone = set()
        for s in range(len(w) - 19):
            if first[tuple(w[s : s + 20])] < (i, s):
                gone.update(range(s, s + 20))
        left = " ".join(x for k, x in enumerate(w) if k not in gone)
        expect.append((d[0], len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    assert as_bag(map(tuple, got)) == as_bag(expect)
    assert sum(r.n_removed for r in got) > 500


def test_gram_hashes_by_doubling():
    x = np.random.default_rng(0).integers(0, 2**63, 40, dtype=np.uint64)
    base = substring_dedup._BASES[0]
    for n in (1, 2, 7, 8, 13, 20):
        got = substring_dedup._grams(x, base, n)
        assert len(got) == 41 - n
        assert int(got[3]) == sum(int(x[3 + j]) * int(base) ** j for j in range(n)) % 2**64


def test_pipeline(spark, docs_dir, empty_dir, rows):
    import corpus_pipeline

    docs = spark.read.parquet(f"{docs_dir}/documents.parquet")
    kinds = docs.select(*corpus_pipeline.COLUMNS).dtypes
    for name, step in corpus_pipeline.STAGES[:3]:
        before, docs = docs.count(), corpus_pipeline.stage(step(spark, docs, docs_dir), name)
        assert docs.dtypes == kinds and 0 < docs.count() <= before
    ids = {r.doc_id for r in docs.collect()}
    packed = corpus_pipeline.run(spark, docs_dir).collect()
    assert {r.doc_id for r in packed} == ids
    assert corpus_pipeline.run(spark, empty_dir).count() == 0


def test_pipeline_keeps_distinct_texts_of_one_id(spark):
    """Rows without an id or of one id are documents of their own, in every stage."""
    import corpus_pipeline

    rng = random.Random(7)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(60)) for _ in range(12)]
    rows = [(None if i < 5 else 7 if i < 9 else i, t, None, "s", 1) for i, t in enumerate(texts)]
    rows += [(3, texts[6], None, "s", 1), (None, texts[10], None, "s", 1), (8, "12 34", None, "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    for name, step in corpus_pipeline.STAGES[:3]:
        docs = corpus_pipeline.stage(step(spark, docs, ""), name)
        got = {r.text: r for r in docs.collect()}
        assert docs.count() == len(texts) + 2 * (name == "language_id") and set(got) == set(texts)
        assert all(r.lang == "und" for r in got.values())
    assert got[texts[6]].doc_id == 3 and got[texts[10]].doc_id == 10 and got[texts[0]].doc_id is None


def test_pipeline_near_copies(spark):
    """The stage against all pairs of plain fingerprints: copies, edited copies, chains, short and empty texts."""
    import corpus_pipeline
    from tillwork.llm.simhash import simhash

    rng = random.Random(9)

    def prose(n):
        return [f"w{rng.randrange(3000)}" for _ in range(n)]

    texts = []
    for _ in range(15):
        base = prose(rng.randint(60, 600))
        texts += [base, list(base)]
        for _ in range(6):
            base = list(base)
            base[rng.randrange(len(base))] = "EDIT" + str(rng.randrange(1000))
            texts.append(base)
    texts += [["a", "b"], ["A", "b"], ["a"], prose(5), prose(6), [], []]
    rng.shuffle(texts)
    rows = [(i, " ".join(t), "en", "s", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    prints = [simhash(r[1]) for r in rows]
    near = {i: [j for j in range(len(prints)) if (prints[i] ^ prints[j]).bit_count() <= 2] for i in range(len(prints))}
    low = linked(list(near), near)
    expect = {i for i in low if low[i] == i}
    assert len(expect) < len(texts) - 20
    got = [r.doc_id for r in corpus_pipeline.simhash_stage(spark, docs, "").collect()]
    assert len(got) == len(set(got)) and set(got) == expect


#: Ids that a double cannot hold, a missing one, and one id with two texts.
ODD_IDS = [2**60 + 1, 2**60 + 3, None, 7, 7]


def test_ids_come_back_as_they_were(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randrange(4000)}" for _ in range(70)) for _ in ODD_IDS]
    texts[1] = texts[1] + " " + texts[3]  # the passage of an earlier document is gone from the later one
    rows = [(k, t, "en", "s", 1) for k, t in zip(ODD_IDS, texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "w1 w2 w3")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name in sorted(QUERIES):
        if name in ("op4_url_filter", "op7_vector_dedup", "op13_collocations", "op11_lexical_search"):
            continue  # no documents, or no row per document
        got = Counter(r.doc_id for r in QUERIES[name](spark, str(tmp_path)).collect())
        assert got == Counter(ODD_IDS) if name != "op6_packing" else set(got) == set(ODD_IDS), name
    for name, step in corpus_pipeline.STAGES[:3]:
        docs = corpus_pipeline.stage(step(spark, docs, ""), name)
        assert Counter(r.doc_id for r in docs.collect()) == Counter(ODD_IDS), name
    assert {r.doc_id for r in corpus_pipeline.packing_stage(spark, docs, "").collect()} == set(ODD_IDS)


def test_substring_dedup_of_one_id_with_two_texts(spark):
    rng = random.Random(13)
    a, b, c = (" ".join(f"w{rng.randrange(5000)}" for _ in range(50)) for _ in range(3))
    rows = [(1, a), (2, a + " " + b), (2, c), (2, c), (3, c), (None, b)]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), nulls_last=True)
    assert Counter((r.doc_id, r.n_removed, r.kept) for r in got.collect()) == Counter(
        [(1, 0, a), (2, 50, b), (2, 0, c), (2, 0, c), (3, 50, ""), (None, 50, "")]
    )


def test_pipeline_passages_of_one_id(spark):
    """Two texts under one id, one of them a copy of an earlier text: neither is lost or doubled."""
    import corpus_pipeline

    rng = random.Random(8)
    a, b = (" ".join(f"w{rng.randrange(5000)}" for _ in range(60)) for _ in range(2))
    rows = [(1, a, "en", "s", 1), (2, a + " tail", "en", "s", 1), (2, b, "en", "s", 1), (2, a, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.passage_stage(spark, docs, "").collect()
    assert Counter((r.doc_id, r.text) for r in got) == {(1, a): 1, (2, b): 1, (2, "tail"): 1}


def test_plain_words_get_the_tokenizers_ids():
    """The rank encoder against the tokenizer: vocabulary words, random and joined words, case, marks, other scripts."""
    import random

    import public_tokenizers

    from tillwork.llm.packing import WordIds

    known = WordIds(public_tokenizers.path("word_bpe_49k.json"))
    assert known.letters is not None
    rng = random.Random(1)
    bare = sorted({k.removesuffix("</w>") for k in known.model.get_vocab()})
    words = rng.sample([k for k in bare if k.isascii() and k.isalpha()], 3000)
    words += ["".join(rng.choices(words, k=3)) for _ in range(2000)]
    words += ["".join(rng.choices("abcdeAB", k=rng.randint(1, 30))) + rng.choice(["", ".", ",", "?"]) for _ in range(2000)]
    words += ["<|endoftext|>", "<|ENDOFTEXT|>", "don't", "I'll.", "a.b.", "...", "É!", "x1,", "日本", "ſK", "ΣΑΣ", "."]
    known.learn({w.encode() for w in words})
    assert all(known[w.encode()] == known._encode(w.encode()) for w in words)


def test_word_ids_stay_bounded_and_right(monkeypatch):
    """A worker keeps at most two generations of CACHE_SIZE words, small enough for the pipeline's executors; ids
    stay those of the tokenizer while generations change."""
    import random

    import public_tokenizers

    from tillwork.llm import packing

    assert 2 * packing.CACHE_SIZE <= 200_000
    monkeypatch.setattr(packing, "CACHE_SIZE", 40)
    known = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(7)
    texts = [" ".join("".join(rng.choices("abcdeXY.,", k=rng.randint(1, 9))) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    for at in range(0, len(texts), 20):
        got = known.encode(texts[at : at + 20])
        assert len(known) <= 40 + 600 and len(known.former) <= 40 + 600  # a generation, and the block that fills it
        want = [np.asarray(known.model.encode(t, add_special_tokens=False).ids, dtype=known.width).tobytes() for t in texts[at : at + 20]]
        assert got == want
