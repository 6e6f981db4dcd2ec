"""The training-data operators against brute force, the libraries they match, and odd inputs."""

import hashlib
import itertools
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mailgrove.llm import ann, bpe, langid, licenses, linededup, packing, registry, shared, simhash, tokens, tokenstore, toxicity, vecdedup

SF = "/root/testdata/sf0.001"
LONG = "the quick brown fox jumps over a lazy dog " * 3000
LINE = "this very line is shared by some documents"
TEXTS = [
    (1, "Hello there world of words"),
    (2, "hello THERE world of words"),
    (3, None),
    (4, ""),
    (5, " \n\t\n "),
    (6, LONG),
    (7, LONG),
    (8, f"a\n{LINE}\nb"),
    (9, f"  {LINE.upper()} \n{LINE}"),
    (10, f"{LINE}\nzzz"),
    (10, f"{LINE}\nzzz"),
    (None, f"{LINE}\nnull id"),
    (12, "Licensed under the Apache License, Version 2.0.\n12345 <|endoftext|> Σς ½ 'll"),
    (13, "1234 5678"),
]
KIND = "doc_id long, text string, lang string, source string, n_chars long, fp long, tag string, pos int, score double, label string, n long, hi long"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, "x", 2, 0.5, "y", 3, 4) for i, t in TEXTS], KIND)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def _find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def _classes(n, pairs):
    parent = list(range(n))
    for a, b in pairs:
        a, b = sorted((_find(parent, a), _find(parent, b)))
        parent[b] = a
    return [_find(parent, i) for i in range(n)]


def _slow_print(text):
    w = (text or "").encode().lower().split()
    parts = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_simhash_prints():
    for _, t in TEXTS:
        if t is not LONG:
            assert simhash.fingerprint(t) == _slow_print(t)


@pytest.mark.parametrize("group", [32, 1])
def test_simhash_links(spark, group):
    """Both paths of a key group give the components of brute force; group=1 sends every group down the linear path."""
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(0, 1 << 63, 12)]
    prints = sorted({b ^ sum(1 << int(k) for k in rng.choice(64, int(rng.integers(0, 5)), replace=False)) for b in base for _ in range(12)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = {r["node"]: r["root"] for r in shared.components(simhash.links(df, group=group)).collect()}
    want = _classes(len(prints), [(i, j) for i, j in itertools.combinations(range(len(prints)), 2) if bin(prints[i] ^ prints[j]).count("1") <= 2])
    groups = {}
    for i, c in enumerate(want):
        groups.setdefault(c, []).append(signed[i])
    for members in groups.values():
        assert {got.get(m, m) for m in members} == {min(members)}


def test_simhash_odd(odd, none):
    rows = {(r["doc_id"], r["component_id"]) for r in simhash.simhash_classes(odd).collect()}
    assert {(2, 1), (4, 3), (5, 3), (7, 6), (10, 10)} <= rows and simhash.simhash_classes(none).count() == 0


def test_components_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in shared.components(edges).collect()}
    assert all(got[i] == 0 for i in range(201)) and got[501] == 500 and shared.components(edges.limit(0)).count() == 0


def _slow_lines(rows, min_docs=3):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    held = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            held.setdefault(key(line), set()).add(linededup.NO_ID if i is None else i)
    gone = {k: max(d) for k, d in held.items() if len(k) >= 20 and len(d) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if key(x) not in gone or (linededup.NO_ID if i is None else i) == gone[key(x)]]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_line_dedup(spark, odd, none, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    many = [(i, f"{LINE}\nown line number {i} of this text\n{'common but not so much ' * (i % 3 == 0)}\n{LINE if i % 5 == 0 else ''}") for i in range(100, 160)]
    rows = TEXTS + many
    docs = odd.select("doc_id", "text").union(spark.createDataFrame(many, "doc_id long, text string"))
    digest = lambda lines, keep: linededup.kept_text(lines, keep)
    got = linededup._judged(docs, 20, 3, "kept string", digest, __import__("pyarrow").string()).collect()
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    order = lambda r: tuple(str(x) for x in r)
    assert sorted([tuple(r) for r in got], key=order) == sorted(_slow_lines(rows), key=order)
    assert linededup.dedup_lines(none).count() == 0
    kept = linededup.dedup_lines(docs).where("doc_id = 100").first()
    assert linededup.unpack_bits(kept["keep"], kept["n_lines"]).sum() == kept["n_lines"] - kept["n_dropped"]


def test_line_dedup_stage_keeps_columns(odd):
    out = linededup.dedup_stage(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert all(r["n_chars"] == len(r["text"] or "") for r in out.where("text IS NOT NULL").collect())


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cached_encoder(name):
    path = tokens.vocabulary(name)
    tok, enc = Tokenizer.from_file(path), tokens.Encoder(path, tokens.vocabulary("byte_bpe_50k.tiktoken") if name[0] == "b" else None)
    rng = np.random.default_rng(5)
    letters = list("abcé ’'s'll \n\t\r  ΣσİßÀ12²½<|>.,!?\x1c\x85\xa0中文\x00e")
    texts = [t for _, t in TEXTS if t] + ["".join(rng.choice(letters, int(rng.integers(0, 40)))) for _ in range(500)] + ["a\n\nb", "end\n", " x"]
    for t, ids in zip(texts, enc.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, ascii(t)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cached_encoder_random(name):
    """Random texts of letters that change with case or composition, marks and odd spaces."""
    rng = np.random.default_rng(5)
    letters = list("aAbEéèßñÀ\u0130ıΣς²½Ⅷ5'sStdlv.,!#$%&()*-/:;<=>@[]^_`{|}~\" \n\u0301\u0338\u0307日\u0958ﬁ٣…“\x00\xa0")
    texts = ["".join(rng.choice(letters, rng.integers(0, 60))) for _ in range(3000)]
    enc = tokens.Encoder(tokens.vocabulary(name))
    want = [enc.whole(t) for t in texts]
    assert enc.encode(texts) == want
    sliced = __import__("pyarrow").array(texts).slice(700, 900)
    ids, ends = enc.batch(sliced)
    assert [ids[a:b].astype("<u4").tobytes() for a, b in zip(ends, ends[1:], strict=False)] == want[700:1600]
    if name[0] == "b":  # the ranked path, too
        assert tokens.Encoder(tokens.vocabulary(name), tokens.vocabulary("byte_bpe_50k.tiktoken")).encode(texts) == want
    else:  # the transducer codec and its decoder
        apart = tokens.words_apart(sliced)
        apart.validate(full=True)
        assert enc.encode(apart.to_pylist())[:50] == [enc.whole(t) for t in apart.to_pylist()[:50]]
        codec = bpe.Codec(bpe.Vocabulary(tokens.vocabulary(name)), None)
        ids, ends = codec.encode(__import__("pyarrow").array(texts))
        assert [ids[a:b].astype("<u4").tobytes() for a, b in zip(ends, ends[1:], strict=False)] == want
        assert codec.decode(ids, ends).to_pylist() == [enc.tok.decode(np.frombuffer(w, "<u4").tolist(), skip_special_tokens=False) for w in want]


def test_bpe_codec(odd, none):
    path = tokens.vocabulary("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    rows = bpe.encode_documents(odd, path, lexicon_size=50).collect()
    got = sorted((r["doc_id"] or 0, bytes(r["ids"]), bytes(r["decoded"])) for r in rows)
    want = []
    for i, t in TEXTS:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want.append((i or 0, np.array(ids, "<u4").tobytes(), tok.decode(ids, skip_special_tokens=False).encode()))
    assert got == sorted(want) and bpe.encode_documents(none, path).count() == 0


def test_words_merged_together():
    v = bpe.Vocabulary(tokens.vocabulary("word_bpe_49k.json"))
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("aeionrstthlé中ß,.!-"), rng.integers(1, 30))) for _ in range(3000)] + ["a", "aa" * 31, "ab" * 200, "é", "the", "!!!!!!!!"]
    assert v.merge_all(words) == [v.merge(w) for w in words] and v.merge_all([]) == []


def test_lexicon_is_minimal_and_exact():
    words = {w.encode(): [i, i + 1] for i, w in enumerate(["tap", "taps", "top", "tops", "stop", "stops"])}
    lex = bpe.Lexicon(np.frombuffer(bpe.compile_lexicon(words), np.uint8))
    assert [list(x) for x in lex.find(list(words))] == list(words.values()) and lex.find([b"to", b"", b"topsy"]) == [None] * 3
    assert len(lex.final) == 7  # one state for each distinct set of endings


def test_token_store(spark, odd, none):
    path, folder = tokens.vocabulary("word_bpe_49k.json"), shared.new_path(spark, "test-shards")
    manifest = tokenstore.write_shards(odd, folder, path)
    rows = tokenstore.read_shards(spark, manifest).collect()
    tok = Tokenizer.from_file(path)
    want = sorted((i if i is not None else -1, [*tok.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in TEXTS)
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, np.frombuffer(r["ids"], "<u4").tolist()) for r in rows)
    assert got == want and sorted(r["start"] for r in rows)[0] == 0
    from pyarrow import fs

    where, inner = fs.FileSystem.from_uri(manifest[-1]["path"])
    with where.open_input_file(inner) as f:
        reader = tokenstore.Reader(f, f.size())
        assert reader.get(13).tolist() == [*tok.encode("1234 5678", add_special_tokens=False).ids, 2] and reader.get(99) is None
    assert tokenstore.read_shards(spark, tokenstore.write_shards(none, folder + "-none", path)).count() == 0


def test_token_store_of_many_shards(spark):
    """Running starts, crcs and lookups over several shards; absent keys; the filter's rate; a hot id."""
    rng = np.random.default_rng(9)
    rows = [(int(i), " ".join(rng.choice(["alpha", "beta", "gamma's", "12"], int(rng.integers(0, 60))))) for i in rng.permutation(900) * 3 - 600] + [(30, f"again {i}") for i in range(40)]
    path, folder = tokens.vocabulary("word_bpe_49k.json"), shared.new_path(spark, "test-shards")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    manifest = tokenstore.write_shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), folder, path)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(manifest) > 2 and sum(m["docs"] for m in manifest) == len(rows)
    enc = tokens.Encoder(path)
    start, want = 0, []
    for i, t in sorted(rows):
        ids = [*np.frombuffer(enc.whole(t), "<u4").tolist(), 2]
        want.append((i, start, ids))
        start += len(ids)
    got = sorted((r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4").tolist()) for r in tokenstore.read_shards(spark, manifest).collect())
    assert got == want
    from pyarrow import fs

    known, absent, wrong = {i: ids for i, _, ids in want if i != 30}, 0, 0
    for m in manifest:
        where, inner = fs.FileSystem.from_uri(m["path"])
        with where.open_input_file(inner) as f:
            reader = tokenstore.Reader(f, f.size())
            for i in range(-599, 2100, 3):  # none of these is an id
                assert reader.get(i) is None
                wrong += reader.may_have(tokenstore.key_of(i))
                absent += 1
            for i in list(known):
                if (ids := reader.get(i)) is not None:
                    assert ids.tolist() == known.pop(i)
    assert not known and wrong < 0.03 * absent


def test_packing(odd, none):
    path = tokens.vocabulary("byte_bpe_50k.json")
    rows = packing.pack(odd, path, window=64).toPandas()
    tok = Tokenizer.from_file(path)
    assert rows.length.sum() == sum(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in TEXTS)
    rows = rows.sort_values(["sequence_id", "offset"])
    assert (rows.groupby("sequence_id").length.cumsum() - rows.length == rows.offset).all() and rows.groupby("sequence_id").length.sum().max() <= 64
    assert rows.sequence_id.nunique() <= -(-rows.length.sum() // 64) + 1 and packing.pack(none, path).count() == 0


def test_packing_plan_covers_everything():
    rng = np.random.default_rng(1)
    for n in (0, 1, 30, 3000):
        h = {int(k): int(v) for k, v in zip(*np.unique(rng.integers(1, 1025, n), return_counts=True), strict=True)}
        seen = {}
        bins = packing.plan(h)
        for count, inside in bins:
            assert sum(s * k for s, k in inside) <= 1024
            for s, k in inside:
                seen[s] = seen.get(s, 0) + count * k
        assert seen == h and (n < 3000 or sum(c for c, _ in bins) <= 1.02 * sum(s * k for s, k in h.items()) / 1024)


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8))
    x[50:90] = x[:40] + rng.normal(size=(40, 8)) * 0.2
    x[100:140] = x[99]
    rows = [(i, [float(f) for f in np.float32(v)], 1) for i, v in enumerate(x)]
    rows += [(1000, None, 1), (1001, [0.0] * 8, 1), (1002, [float("nan")] * 8, 1), (1003, [1.0, None] * 4, 1), (1020, [float("inf")] * 8, 1), (1040, [1.0], 1)]  # 1040: alone in its length
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell int")


def test_vector_near_duplicates(vectors):
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vecdedup.near_duplicates(vectors).collect()}
    rows = [(r["vec_id"], np.array(r["embedding"], float)) for r in vectors.where("vec_id < 300").orderBy("vec_id").collect()]
    x = np.stack([v for _, v in rows])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = u @ u.T >= 0.9
    want = _classes(300, [(i, j) for i, j in zip(*np.nonzero(hit), strict=True) if i < j])
    assert {i: got[i] for i in range(300)} == {i: (int(hit[i].sum()) - 1, want[i]) for i in range(300)}
    assert all(got[i] == (0, i) for i in (1000, 1001, 1002, 1003, 1020, 1040))
    assert vecdedup.near_duplicates(vectors.limit(0)).count() == 0


def test_tree_search(vectors):
    rows = ann.search(vectors, lambda v: v % 20 == 0).collect()
    x = np.array([r["embedding"] for r in vectors.where("vec_id < 300").orderBy("vec_id").collect()], float)
    found = total = 0
    for q in range(0, 300, 20):
        s = (x[q] * x).sum(axis=1)
        s[q] = -np.inf
        want = np.lexsort((np.arange(300), -s))[:20]
        got = sorted((r["rank"], r["vec_id"], r["score"]) for r in rows if r["query_id"] == q)
        assert [g[0] for g in got] == list(range(1, 21)) and all(g[2] == s[g[1]] for g in got)
        assert got == sorted(got, key=lambda g: (-g[2], g[1]))
        found += len({g[1] for g in got} & set(want.tolist()))
        total += 20
    assert found / total >= 0.9 and {r["query_id"] for r in rows} == set(range(0, 300, 20))
    assert ann.search(vectors.limit(0), lambda v: v % 20 == 0).count() == 0


def test_vectors_repeated_and_of_other_lengths(spark):
    """Equal rows, repeated query rows and vectors of rarer lengths, against brute force."""
    rng = np.random.default_rng(12)
    x = [list(map(float, np.float32(v))) for v in rng.normal(size=(60, 8))]
    rows = [(i, v) for i, v in enumerate(x)] + [(20, x[20]), (20, x[20]), (40, x[3]), (None, x[3]), (None, x[5]), (100, [1.0, 2.0]), (101, [1.0, 2.0]), (102, [2.0, -1.0]), (120, [2.0, 4.0])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, row int, d int")

    def near(a, b):
        return len(a) == len(b) and np.dot(a, b) / np.sqrt(np.dot(a, a) * np.dot(b, b)) >= 0.9

    pairs = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if near(rows[i][1], rows[j][1])]
    root = _classes(len(rows), pairs)
    ids = [sorted(rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None) for i in range(len(rows))]
    want = sorted(((rows[i][0], sum(i in p for p in pairs), ids[i][0] if ids[i] else None) for i in range(len(rows))), key=str)
    assert sorted((tuple(r) for r in vecdedup.near_duplicates(df).collect()), key=str) == want
    got = sorted((r["query_id"], r["rank"], -1 if r["vec_id"] is None else r["vec_id"], r["score"]) for r in ann.search(df, lambda v: v % 20 == 0, target=1.0).collect())
    want = []
    for q, (i, v) in enumerate(rows):
        if i is not None and i % 20 == 0:
            s = sorted((-float((np.array(v) * np.array(w)).sum()), -(1 << 62) if j is None else j) for at, (j, w) in enumerate(rows) if at != q and len(w) == len(v))
            want += [(i, k + 1, -1 if j < 0 else j, -score) for k, (score, j) in enumerate(s[:20])]
    assert got == sorted(want)


def test_language_id(spark, odd, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fitted = langid.fit(langid.training_rows(docs))
    held = docs.join(langid.predict(docs.select("doc_id", "text"), fitted), "doc_id").where(langid.fold(F.col("doc_id"), 4) == 2)
    assert held.where("lang = lang_pred").count() >= 0.95 * held.count()
    rows = {r["doc_id"]: r for r in langid.predict(odd.select("doc_id", "text"), fitted).collect()}
    assert rows[3]["lang_pred"] == rows[13]["lang_pred"] == rows[4]["lang_pred"] == "und" and rows[3]["score"] == 0 and rows[1]["lang_pred"] != "und"
    assert langid.predict(none.select("doc_id", "text"), fitted).count() == 0
    assert langid.predict(odd.select("doc_id", "text"), langid.fit(none)).where("lang_pred <> 'und'").count() == 0


def test_toxicity(spark, odd, none):
    rng = np.random.default_rng(4)
    plain = ["river", "stone", "garden", "window", "paper", "silver", "morning", "bread"]
    rows = []
    for i in range(1200):
        w = list(rng.choice(plain, 40))
        if i % 6 == 0:
            w[int(rng.integers(40))] = "zorgblat"
        rows.append((i, " ".join(w), int(i % 6 == 0)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(1, None), (None, 1)], "doc_id long, toxic int")
    fitted = toxicity.fit(toxicity.labelled(docs, labels))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, fitted).collect()}
    assert sum((got[i] >= 0.5) == bool(y) for i, _, y in rows) >= 0.97 * len(rows)
    assert toxicity.score(odd, fitted).count() == odd.count() and all(0 <= r["score"] <= 1 for r in toxicity.score(odd, fitted).collect())
    empty = toxicity.fit(toxicity.labelled(none, labels))
    assert toxicity.score(odd, empty).where("score <> 0").count() == 0


def test_language_edges(spark, odd, none):
    """Letters by their Unicode class; nothing learned; gibberish and unknown languages go, known ones stay."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fitted = langid.fit(langid.training_rows(docs))
    rng = np.random.default_rng(6)
    noise = " ".join("".join(rng.choice(list("bcdfghjklmnpqrstvwxyz"), 7)) for _ in range(40))
    some = spark.createDataFrame([(1, "½ ² 12"), (2, None), (3, noise), (4, "это русский текст о погоде и о людях"), (5, " ")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in langid.predict(some, fitted).collect()}
    assert [rows[i]["lang_pred"] for i in (1, 2, 5)] == ["und"] * 3 and all(rows[i]["score"] == 0 for i in (1, 2, 5)) and all(r["rejected"] for r in rows.values())
    assert langid.stage(docs).count() >= 0.98 * docs.count()
    untaught = spark.createDataFrame([(1, "hello there", None), (3, None, "en")], "doc_id long, text string, lang string")
    assert langid.stage(untaught).count() == 0 and langid.stage(none).count() == 0


def test_toxicity_with_few_labels(spark):
    """One toxic row still makes a model; the curve then comes from the rows at hand."""
    docs = spark.createDataFrame([(i, f"quiet words number {'x' * (i % 7)} and more") for i in range(40)] + [(100, "zorgblat zorgblat you zorgblat")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i == 100)) for i in [*range(40), 100]], "doc_id long, toxic int")
    fitted = toxicity.fit(toxicity.labelled(docs, labels, held=99))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, fitted).collect()}
    assert fitted.model is not None and got[100] == max(got.values()) > got[0]


CLASH = "Text string, DOC_ID string, text string, doc_id long, lang string, Lang string, source string, n_chars long"


def test_names_that_differ_in_case(spark):
    """Extra columns called like the operators' own but for case change nothing."""
    import corpus_pipeline

    rows = [(None, "x", t, i, "en", "q", "s", 3) for i, t in TEXTS]
    clash, plain = spark.createDataFrame(rows, CLASH), spark.createDataFrame([(t, i, "en", "s", 3) for i, t in TEXTS], "text string, doc_id long, lang string, source string, n_chars long")
    same = lambda f: sorted(map(str, f(clash).collect())) == sorted(map(str, f(plain).collect()))
    assert same(simhash.simhash_classes) and same(linededup.dedup_lines) and same(lambda d: bpe.encode_documents(d, tokens.vocabulary("word_bpe_49k.json"), 20))
    assert same(lambda d: packing.pack(d, tokens.vocabulary("byte_bpe_50k.json")).select("doc_id", "piece", "length", "ids_crc32"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out, want = stage(spark, clash, SF), stage(spark, plain, SF)
        assert out.columns == clash.columns, name
        key = lambda r: str((r[3], r[2], r[7]))
        assert sorted(map(key, out.collect())) == sorted(str((r["doc_id"], r["text"], r["n_chars"])) for r in want.collect()), name


def test_licenses(spark, odd, none):
    files = odd.select("doc_id", F.concat(F.when(F.col("doc_id") < 5, "far/").otherwise("top/sub/"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias("path"), "text", "tag")
    licensed = spark.createDataFrame([(None, "a/x", "Released under the MIT License."), (None, "a/x", "words"), (None, None, "Licensed under CC BY-NC 4.0.")], "doc_id long, path string, text string")
    assert sorted((r["path"], r["license_id"], r["cosine"] is not None, r["declared_in"]) for r in licenses.license_scan(licensed).collect()) == [("", "CC-BY-NC-4.0", True, ""), ("a/x", "MIT", False, "a"), ("a/x", "MIT", True, "a/x")]
    got = {r["doc_id"]: r for r in licenses.license_scan(files).collect()}
    assert got[12]["license_id"] == "Apache-2.0" and got[12]["declared_in"] == "top/sub/12" and got[13]["license_id"] == "Apache-2.0" and got[13]["declared_in"] == "top/sub" and got[1]["license_id"] is None
    assert licenses.license_scan(none.withColumn("path", F.lit("x"))).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    now, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = shared.settle(stage(spark, now, SF), name)
        assert now.columns == docs.columns
        kept[name] = now.count()
    assert kept["toxicity"] >= 0.8 * docs.count() and kept["language_id"] >= 0.98 * kept["toxicity"] and kept["line_dedup"] == kept["language_id"]
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, SF)
    assert {r["doc_id"] for r in pieces.collect()} == {r["doc_id"] for r in now.select("doc_id").collect()}
    tok = Tokenizer.from_file(tokens.vocabulary("byte_bpe_50k.json"))
    text = {r["doc_id"]: r["text"] for r in now.select("doc_id", "text").collect()}
    for r in pieces.limit(50).collect():
        ids = [*tok.encode(text[r["doc_id"]] or "", add_special_tokens=False).ids, 2][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r["ids_crc32"]


def test_registry():
    assert [n.split("_")[0] for n in registry.queries()] == ["op1", "op2", "op3", "op4", "op5", "op6", "op7", "op8", "op9", "op10", "pipeline"]
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
