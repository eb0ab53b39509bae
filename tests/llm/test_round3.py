"""Clustering, Merkle manifest and packing against brute force, and on nulls, empties, ties, repeats, long texts and clashing columns."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from creaseline.llm import best_fit_packing, merkle_manifest, pca_clustering

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
rng = random.Random(11)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- clustering -----------------------------------------------------------------------------------


def brute_clusters(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    centroids = [v for _, v in sorted(kept, key=lambda r: (sha(f"1:{'' if r[0] is None else r[0]}"), r[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in kept:
            own[near(v)[1]].append(v)
        centroids = [[sum(x) // len(own[j]) for x in zip(*own[j], strict=True)] if own[j] else c for j, c in enumerate(centroids)]
    found = [(i, *near(v)) for i, v in kept]
    inertia = Counter()
    for _, d, c in found:
        inertia[c] += d
    fits = lambda x: x if x < 1 << 63 else None
    return sorted(((i, c, d, fits(inertia[c]), fits(sum(inertia.values())), sha(",".join(map(str, centroids[c])))) for i, d, c in found), key=str)


@pytest.mark.parametrize("shape", ["spread", "flat", "few", "far"])
def test_clusters_are_exact(spark, shape):
    make = {"spread": lambda i: [rng.gauss(i % 5, 1) for _ in range(64)], "flat": lambda i: [1.25] * 64, "few": lambda i: [float(i)] * 64, "far": lambda i: [rng.choice([-2e6, 2e6, 0.01]) for _ in range(64)]}[shape]
    rows = [(i, make(i)) for i in range(5 if shape == "few" else 150)]
    rows += [(7, rows[3][1]), (7, rows[3][1]), (None, rows[4][1]), (900, None), (901, [1.0] * 63), (902, [None] * 64), (903, [math.nan] * 64), (904, [math.inf] + [0.0] * 63), (905, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"cluster": F.lit("mine"), "id": F.lit(0)}).repartition(3)
    got = pca_clustering.members_with_inertia(pca_clustering.cluster(df, dim=64, k=16, rounds=3, salt="1:"))
    assert sorted((tuple(r) for r in got.select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=str) == brute_clusters(rows)


def test_clusters_of_nothing_and_of_too_much(spark):
    nothing = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert pca_clustering.members_with_inertia(pca_clustering.cluster(nothing, 64, 16, 3, "1:")).count() == 0
    huge = spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64-bit"):
        pca_clustering.cluster(huge, 64, 16, 3, "1:")


def test_bounds_save_distances_and_never_decide():
    r = np.random.default_rng(5)
    centres = r.integers(-3000, 3000, (16, 64))
    v = centres[r.integers(0, 16, 4000)] + r.integers(-60, 60, (4000, 64))
    axes = np.linalg.eigh(np.cov(v.T))[1][:, ::-1]
    lead, rest = pca_clustering.rotated(v.astype(float), v.mean(0), axes, 12)
    c_lead, c_rest = pca_clustering.rotated(centres.astype(float), v.mean(0), axes, 12)
    cluster, distance, tried = pca_clustering.assign(v, lead, rest, centres, c_lead, c_rest)
    every = ((v[:, None] - centres) ** 2).sum(2)
    assert (cluster == every.argmin(1)).all() and (distance == every.min(1)).all() and tried < 1.1 * len(v)


# -- Merkle ---------------------------------------------------------------------------------------


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def brute_manifest(rows, tampered, fan=3):
    leaf = lambda r, text: sha("".join(map(field, (r[0], r[3], r[2], r[4], text))))  # noqa: E731  doc_id, source, lang, n_chars, text
    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i : i + fan])) for i in range(0, len(levels[-1]), fan)])
        return levels
    def around(levels, at):
        out = []
        for nodes in levels[:-1]:
            run = at // fan * fan
            out.append((nodes[run:at], nodes[at + 1 : run + fan]))
            at //= fan
        return out
    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for at, (_, _, h, r) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            path = around(trees[s], at) + around(top, k)
            fold = leaf(r, r[1].replace("\n", "")) if tampered(r) and r[1] is not None else h
            for left, right in path:
                fold = sha("".join(left) + fold + "".join(right))
            out.append((r[0], h, trees[s][-1][0], top[-1][0], sha("".join("".join(a + b) for a, b in path)), fold, fold == top[-1][0]))
    return sorted(out, key=str)


def hit(r):
    return r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0


@pytest.mark.parametrize("levels", [1, 2, 5])
def test_manifest(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle_manifest, "LEVELS", levels)
    sources = ["hot"] * 90 + ["b"] * 9 + ["é"] * 4 + ["", "lone", None, None]
    rows = [(i, rng.choice(["a\nb", "plain", "", None, "日本\n"]), rng.choice(["en", None]), s, rng.choice([3, None])) for i, s in enumerate(sources)]
    rows += [rows[0], rows[0], (5, "other", "en", "hot", 1), (None, "x\ny", None, "hot", None), (None, "x\ny", None, "hot", None), (500, "z\n" * 200_000, "en", "b", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({"leaf": F.lit(1), "path": F.lit("p"), "root": F.lit("r")}).repartition(5)
    leaves = merkle_manifest.document_leaves(df, F.crc32(F.col("doc_id").cast("string")) % 2 == 0)
    made = merkle_manifest.manifest(leaves, "source", "doc_id")
    got = made.proofs()
    want = brute_manifest(rows, hit)
    assert sorted((tuple(r) for r in got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str) == want
    assert 0 < sum(not x[6] for x in want) < len(want) and made.roots().collect()[0].root == want[0][3]
    assert [level for level, _ in made.groups.levels] == list(range(0, 5, levels))  # 95 leaves: five levels


def test_manifest_of_one_and_of_nothing(spark):
    ddl = "doc_id long, text string, lang string, source string, n_chars long"
    no = F.lit(False)
    one = merkle_manifest.manifest(merkle_manifest.document_leaves(spark.createDataFrame([(1, None, None, None, None)], ddl), no), "source", "doc_id").proofs().first()
    assert one.leaf == one.subroot == one.root == one.folded_root == sha("1:1----") and one.proof_sha256 == sha("") and one.verified
    nothing = merkle_manifest.manifest(merkle_manifest.document_leaves(spark.createDataFrame([], ddl), no), "source", "doc_id")
    assert nothing.proofs().count() == 0 and nothing.roots().count() == 0


# -- packing --------------------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["mixed", "large", "one", "tiny", "third"])
def test_plan_holds_every_piece_in_few_sequences(kind):
    r = np.random.default_rng(3)
    lengths = {"mixed": r.integers(1, 2049, 5000), "large": r.integers(700, 2048, 5000), "one": np.full(999, 1025), "tiny": r.integers(1, 30, 5000), "third": np.concatenate([np.full(3000, 683), r.integers(1, 2048, 3000)])}[kind]
    counts = Counter(lengths.tolist())
    plan = best_fit_packing.packing_plan(counts)
    held = Counter()
    for items, times in plan:
        assert times > 0 and sum(n * each for n, each in items) <= 2048
        for n, each in items:
            held[n] += each * times
    assert held == counts
    used, least = sum(t for _, t in plan), -(-int(lengths.sum()) // 2048)
    plain = sum(t for _, t in best_fit_packing.fill([], counts, 2048))  # best fit alone, longest first
    assert used <= (999 if kind == "one" else 1.003 * plain) and used >= least
    many = best_fit_packing.packing_plan({n: c * 10**9 for n, c in counts.items()})
    assert len(many) < 8000 and sum(t for _, t in many) <= used * 10**9 * 1.01  # its size does not grow with the corpus


def test_knapsack_and_configurations():
    sizes, values = np.array([900, 700, 520]), np.array([0.5, 0.34, 0.26])
    best = max((sum(c * v for c, v in zip(x, values, strict=True)), x) for x in ((a, b, c) for a in range(3) for b in range(3) for c in range(4)) if sum(n * s for n, s in zip(x, sizes, strict=True)) <= 2048)
    value, counts = best_fit_packing.knapsack(sizes, values, 2048)
    assert abs(value - best[0]) < 1e-9 and int(counts @ sizes) <= 2048
    for size in (1024, 2047, 600):
        (c, x), = best_fit_packing.configurations(np.array([size]), np.array([10.0]), 2048)
        assert c[0] == 2048 // size and abs(x * c[0] - 10) < 1e-9


def brute_pieces(rows):
    t = Tokenizer.from_file(VOCABULARY)
    out = []
    for d, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % 2048 or min(2048, len(ids))
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            out.append((d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return sorted(out, key=str)


def test_packing(spark):
    words = [chr(rng.randrange(97, 123)) * rng.randrange(1, 5) + rng.choice(["", "é", "日", "\n", "  ", "'s", "1"]) for _ in range(300)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([3, 40, 300, 900, 2500])))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "x" * 200_000), (103, "<|endoftext|> a <|endoftext|>"), (104, " \n\t "), (3, rows[3][1]), (3, rows[3][1]), (None, "no id"), (None, None), (105, "\x1c \x85  ́a😀")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"piece": F.lit("p"), "ids": F.lit(1), "sequence_id": F.lit(None).cast("int"), "length": F.lit(9)}).repartition(4)
    packed = best_fit_packing.pack_documents(df.select("doc_id", "text", "piece"), VOCABULARY, keep_ids=True).persist()
    got = packed.collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == brute_pieces(rows)
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length, r.ids))
    for own in by.values():
        at = 0
        for offset, length, _ in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) <= -(-sum(r.length for r in got) // 2048) + 1
    whole = {r.sequence_id: bytes(r.ids) for r in best_fit_packing.sequences(packed).collect()}
    assert whole == {k: b"".join(bytes(x[2]) for x in sorted(own)) for k, own in by.items()}
    clash = best_fit_packing.tokenize(df, VOCABULARY)
    assert clash.columns == ["doc_id", "ids"] and clash.count() == len(rows)
    assert best_fit_packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), VOCABULARY).count() == 0


def test_every_character_is_split_alike():
    """tiktoken stands in for tokenizers: both must class each code point alike."""
    slow, fast = Tokenizer.from_file(VOCABULARY), best_fit_packing.encoder(VOCABULARY)
    for lo in range(0, 0x110000, 256):
        if not 0xD800 <= lo < 0xE000:
            text = "".join(f"a{chr(c)}1{chr(c)}!{chr(c)} " for c in range(lo, lo + 256))
            assert fast(text).tolist() == slow.encode(text, add_special_tokens=False).ids, hex(lo)


def test_other_vocabularies_run_in_their_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    text = "Some Words, lower-cased"
    assert best_fit_packing.encoder(path)(text).tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_lengths_that_do_not_fit(spark):
    with pytest.raises(ValueError, match="fit"):
        best_fit_packing.pack(spark.createDataFrame([(1, 3000)], "doc_id long, length long"))


# -- near-duplicates and the pipeline ---------------------------------------------------------------


def test_classes_of_rows_without_ids(spark):
    from creaseline.llm import dart_minhash

    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(None, a), (None, a + " more"), (None, b), (None, b + " more"), (None, "alone in here with six words"), (None, None), (5, a), (None, "")]
    got = dart_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows) == len({r.row_key for r in got})
    classes = defaultdict(list)
    for r in got:
        classes[r.class_key].append((r.doc_id, r.class_id))
    assert sorted((len(x), str(sorted(x, key=str))) for x in classes.values()) == sorted([(3, "[(5, 5), (None, 5), (None, 5)]"), (2, "[(None, None), (None, None)]"), *[(1, "[(None, None)]")] * 3])


def test_repeated_rows_with_maps_arrays_and_structs(spark):
    import corpus_pipeline

    text = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(1, text), (1, text), (2, text), (3, None), (3, None), (4, "other words here")], "doc_id long, text string")
    more = {"m": F.create_map(F.lit("k"), F.col("doc_id")), "a": F.array("doc_id", F.lit(None)), "s": F.struct(F.col("text").alias("x"), F.create_map(F.lit(1), F.lit(2)).alias("y")), "b": F.encode("text", "UTF-8")}
    for name, stage in corpus_pipeline.STAGES:
        if name in ("near_dedup", "secrets", "tokenize"):
            out = stage(spark, df.withColumns(more), "")
            rows = out.collect()
            assert sorted(r.doc_id for r in rows) == ([1, 3, 4] if name == "near_dedup" else [1, 1, 2, 3, 3, 4]), name
            assert all(r.m == {"k": r.doc_id} and r.a == [r.doc_id, None] for r in rows)
