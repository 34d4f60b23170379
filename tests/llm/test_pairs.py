"""Near-duplicates and fingerprints against brute force."""

import hashlib

import numpy as np
import pytest

from newsight.llm import fingerprint, minhash, queries


def brute_components(docs, n, percent=80):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    sets, root = {}, {}
    for d, t in docs:
        w = (t or "").encode().translate(low).split()
        sets[d] = {tuple(w)} if 0 < len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
        root[d] = d

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted((d, len(sets[d]), find(d), find(d) == d) for d in ids)


def as_rows(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect())


def test_near_duplicates_whole_table(spark, sf_dir, documents):
    assert as_rows(queries.op6_minhash(spark, sf_dir)) == brute_components(documents.items(), 4)


@pytest.mark.parametrize("chunk,pairs", [(7, 20), (512, 50_000)])
def test_group_of_near_copies_in_chunks(spark, monkeypatch, chunk, pairs):
    monkeypatch.setattr(minhash, "PAIRS", pairs)
    monkeypatch.setattr(minhash, "CHUNK", chunk)
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(150)]
    docs = []
    for i in range(45):
        words = list(base)
        for p in rng.choice(150, i % 6, replace=False):
            words[p] = f"e{i}_{p}"
        docs.append((i, " ".join(words)))
    docs += [(100 + i, " ".join(f"z{i}_{j}" for j in range(40))) for i in range(20)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert as_rows(minhash.near_duplicates(frame, 5)) == brute_components(docs, 5)


def test_stock_sentences_make_no_candidates(spark):
    rng = np.random.default_rng(11)
    stock = [" ".join(f"s{i}w{j}" for j in range(12)) for i in range(60)]
    docs = [(i, " ".join(stock[k] for k in sorted(rng.choice(60, 30, replace=False)))) for i in range(500)]
    docs += [(1000 + i, docs[i][1] + " tail") for i in range(0, 500, 50)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    sets = minhash.signatures(frame, 5).select("node", "signature")
    blocks = minhash.list_blocks(minhash.prefixes(sets), None)
    assert blocks.groupBy("list", "a", "b").count().agg({"count": "max"}).first()[0] > 50
    # lists are long, but only the ten copies are candidates
    assert minhash.first_partners(blocks).count() == 10
    assert as_rows(minhash.near_duplicates(frame, 5)) == brute_components(docs, 5)


@pytest.mark.parametrize("chunk", [5, 512])
def test_links_that_the_first_pass_misses(spark, monkeypatch, chunk):
    """Two drifting chains and two clusters whose likeness lies just below the bound."""
    monkeypatch.setattr(minhash, "CHUNK", chunk)
    rng = np.random.default_rng(23)
    docs = []
    for chain in range(2):
        words = [f"c{chain}_{i}" for i in range(200)]
        for step in range(30):
            docs.append((chain * 100 + int(rng.permutation(30)[0]) * 1000 + step, " ".join(words)))
            for p in rng.choice(200, 4, replace=False):
                words[p] = f"d{chain}_{step}_{p}"
    base = [f"b{i}" for i in range(200)]
    for cluster, tail in enumerate((24, 30, 36)):
        for i in range(12):
            words = base[: 200 - tail] + [f"t{cluster}_{j}" for j in range(tail)]
            words[int(rng.integers(200))] = f"e{i}"
            docs.append((50_000 + cluster * 100 + i, " ".join(words)))
    docs = sorted(dict(docs).items())
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert as_rows(minhash.near_duplicates(frame, 5)) == brute_components(docs, 5)


def test_block_links_between_sides():
    sets = [np.arange(100, dtype=np.uint64), np.arange(5, 105, dtype=np.uint64), np.arange(300, 400, dtype=np.uint64)]
    u, v = minhash.block_links(sets, np.array([0, 1, 1]), 80)
    assert list(zip(u, v)) == [(0, 1)]
    u, v = minhash.block_links(sets, np.array([0, 0, 0]), 80)
    assert list(zip(u, v)) == [(0, 1)]


def test_near_duplicates_odd_rows(odd, empty):
    rows = [tuple(r) for r in minhash.near_duplicates(odd, 4).collect()]
    assert len(rows) == odd.count()
    got = {r[0]: r for r in rows}
    assert got[2][2:] == (1, False) and got[1][2:] == (1, True) and got[11][2] == 1
    assert got[3][1:] == (0, 3, True) and got[5][1:] == (0, 5, True)
    assert got[7][2:] == (6, False) and got[8][2:] == (6, False)
    assert all(r[2] is None and r[3] is False for r in rows if r[0] is None)
    assert minhash.near_duplicates(empty, 4).count() == 0


def test_fingerprints_whole_table(spark, sf_dir, documents):
    got = {r["doc_id"]: r for r in queries.op7_fingerprint(spark, sf_dir).collect()}
    order = sorted(documents, reverse=True)
    same = {}
    for i, d in enumerate(order):
        text, after = documents[d] or "", documents[order[(i + 1) % len(order)]] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[d]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        alone = fingerprint.fingerprints([fingerprint.codes(text), fingerprint.codes(edited)])
        assert [r["fingerprint"], r["edited_fingerprint"]] == alone
        assert same.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    mean = lambda c: sum(r[c] for r in got.values()) / len(got)
    assert mean("near_edited") > 0.4 and mean("near_next") < 0.05


def test_edit_embedding_tells_edits_from_other_texts():
    rng = np.random.default_rng(9)
    base = rng.integers(97, 123, 2000).astype(np.uint32)
    edited = np.delete(np.insert(base, [300, 900], [97, 98]), [1500])
    other = rng.integers(97, 123, 2000).astype(np.uint32)
    a, b, c = fingerprint.fingerprints([base, edited, other])
    assert fingerprint.likeness(a, b) > 0.8 > 0.2 > fingerprint.likeness(a, c)
    assert fingerprint.likeness(a, a) == 1.0
    assert set(fingerprint.band_keys(a)) & set(fingerprint.band_keys(b))


def test_fingerprints_odd_rows(odd, empty, spark):
    rows = fingerprint.fingerprint_documents(odd).collect()
    assert len(rows) == odd.count()
    one = spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")
    (alone,) = fingerprint.fingerprint_documents(one).collect()
    assert alone["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest() and alone["near_next"] == 1.0
    assert fingerprint.fingerprint_documents(empty).count() == 0


def test_every_pair_of_a_bucket_is_compared(spark):
    rng = np.random.default_rng(5)
    digits = lambda n: "".join(rng.choice(list("0123456789abcdef"), n))
    tail = digits(64)
    opening = digits(64)
    rows = [(1, "05" + opening + digits(64)), (2, "05" + opening + tail), (3, "05" + opening + tail[:-2] + digits(2))]
    rows += [(i, "05" + opening + digits(64)) for i in range(4, 10)]
    got = {
        r["fingerprint"]: tuple(r)[1:]
        for r in fingerprint.near_matches(spark.createDataFrame(rows, "doc_id long, fingerprint string")).collect()
    }
    assert got[rows[1][1]] == (None, None, 2, 1)
    assert got[rows[2][1]] == (2, fingerprint.likeness(rows[1][1], rows[2][1]), 2, 1)
    assert all(got[f] == (None, None, d, 0) for d, f in rows if d not in (2, 3))


def near_copies(documents):
    """Texts with copies: a word in forty replaced, a part of the text cut, or one of three places rewritten."""
    rng = np.random.default_rng(17)
    texts = sorted({t for t in documents.values() if t and 400 < len(t) < 30_000}, key=lambda t: (len(t), t))[::4]
    out = list(texts)
    for i, text in enumerate(texts):
        words, n = text.split(), len(text)
        out.append(" ".join(w if rng.random() > 0.025 else f"x{rng.integers(999)}" for w in words))
        out.append(text[: n - n // 12])
        at = (0, n // 2, n - n // 10)[i % 3]
        out.append(text[:at] + "".join(rng.choice(list("etaoin shrdlu"), n // 10)) + text[at + n // 10 :])
    return out


@pytest.mark.parametrize("chunk", [7, 2048])
def test_classes_against_brute_force(spark, documents, monkeypatch, chunk):
    monkeypatch.setattr(fingerprint, "CHUNK", chunk)
    prints = fingerprint.fingerprints([fingerprint.codes(t) for t in near_copies(documents)])
    frame = spark.createDataFrame(list(enumerate(prints)), "doc_id long, fingerprint string")
    got = {r["fingerprint"]: r for r in fingerprint.near_matches(frame).collect()}
    first = {}
    for d, f in enumerate(prints):
        first.setdefault(f, d)
    nodes = sorted(first, key=first.get)
    keys = {f: set(fingerprint.band_keys(f)) for f in nodes}
    pairs = [(f, g) for i, f in enumerate(nodes) for g in nodes[i + 1 :] if fingerprint.likeness(f, g) >= 0.8]
    met = [(f, g) for f, g in pairs if keys[f] & keys[g]]
    together = sum(got[f]["class_id"] == got[g]["class_id"] for f, g in pairs)
    assert len(pairs) > 40 and together >= 0.9 * len(pairs)
    for f in nodes:
        before = [(first[a], fingerprint.likeness(a, b)) for a, b in met if b == f]
        assert got[f]["n_links"] == sum(f in p for p in met)
        assert (got[f]["near_id"], got[f]["near_likeness"]) == min(before, default=(None, None))


@pytest.mark.parametrize("at", [0, 0.45, 0.9, None])
@pytest.mark.parametrize("n", [6, 25, 150, 1000, 4000])
def test_bands_see_the_whole_text(n, at):
    """A tenth rewritten at one place, or some single letters (None): near copies share a key."""
    rng = np.random.default_rng(3)
    texts = []
    for _ in range(60):
        base = rng.integers(97, 123, n).astype(np.uint32)
        copy = base.copy()
        if at is None:
            copy[rng.choice(n, max(1, n // 150), replace=False)] = 65
        else:
            part = slice(int(n * at), int(n * at) + max(1, n // 10))
            copy[part] = rng.integers(97, 123, len(copy[part]))
        texts += [base, copy]
    prints = fingerprint.fingerprints(texts)
    pairs = [p for p in zip(prints[::2], prints[1::2], strict=True) if p[0] != p[1] and fingerprint.likeness(*p) >= 0.8]
    met = sum(bool(set(fingerprint.band_keys(a)) & set(fingerprint.band_keys(b))) for a, b in pairs)
    assert met >= 0.9 * len(pairs)
