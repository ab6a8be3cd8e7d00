"""Each operator on small tables with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from scriptloom.llm import (
    bpe, chat, html_text, huffman, kmeans_tree, mixing, quality, simhash, topk, toxicity,
)

PATH = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, row int, score string"
PIECES = (
    "the", "Of", "ing", "'re", "don't", "É", "é", "Σ", "ß", "İ", "漢字", "😀", "\x1c", "\x85", "²", "\n", " ",
    "<|endoftext|>", "<|", "!!", "123", "na" * 20, " ", "_", "ﬁ",
)


def texts(n=60, seed=1):
    rnd = random.Random(seed)
    made = [" ".join(rnd.choices(PIECES, k=rnd.randint(1, 30))) for _ in range(n)]
    return [None, "", " \n ", "word", "nana" * 5000, "!?" * 3000, *made, made[0], made[0]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 9 == 0 else "en", f"s{i % 3}" if i % 7 else None, 1, "x", i, "y") for i, t in enumerate(texts())]
    rows += [rows[5], (None, "no id", "en", "s1", 1, "x", 0, "y")]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def library_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def packed(ids):
    return np.array(ids, dtype="<u4").tobytes()


def test_bpe_matches_the_library(docs, empty, library):
    text_of = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = bpe.encode_decode(docs, PATH, with_ids=True).collect()
    assert len(rows) == docs.count()
    for row in rows:
        ids = library_ids(library, text_of[row["doc_id"]])
        assert row["ids"] == ids and row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(packed(ids)).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.encode_decode(empty, PATH).count() == 0


def test_bpe_random_words_match_the_library(library):
    table, rnd = bpe.vocabulary(PATH), random.Random(5)
    for _ in range(1500):
        text = "".join(rnd.choices("abeinorst'é", k=rnd.randint(1, 24)))
        assert np.frombuffer(table.encode(text), dtype="<u4").tolist() == library_ids(library, text)


def test_code_is_canonical_limited_and_round_trips():
    rng = np.random.default_rng(0)
    for ids in (rng.zipf(1.3, 30000) % 5000, np.array([7]), np.array([7, 7]), 2 ** rng.integers(0, 12, 9000)):
        counts = np.bincount(ids)
        lengths = huffman.code_lengths(counts, 13)
        used = lengths[lengths > 0].astype(float)
        assert lengths.max() <= 13 and (2.0**-used).sum() <= 1
        code = huffman.Code(lengths)
        offsets, payload = code.encode(ids)
        assert (code.decode(offsets, payload, len(ids)) == ids).all()
    # the best code without a limit that binds: lengths by merging the two rarest again and again
    counts = np.array([5, 9, 12, 13, 16, 45])
    assert huffman.code_lengths(counts).tolist() == [4, 4, 3, 3, 3, 1]


def test_token_tables_are_bounded_and_give_the_library_ids(library, monkeypatch):
    rnd = random.Random(3)
    made = ["".join(rnd.choices("abc,. 'é1\n", k=rnd.randint(1, 60))) for _ in range(3000)] + ["w" * 500 + " a", *map(str, texts())]
    encoder = huffman.LibraryEncoder(PATH, held_bytes=20_000)
    for start in range(0, len(made), 50):
        part = made[start : start + 50]
        assert encoder.encode(part) == [packed(library_ids(library, t)) for t in part]
        assert encoder.bytes < 200_000
    monkeypatch.setattr(encoder, "ends", np.ones_like(encoder.ends))  # words that cannot be told apart
    part = [f"unheard{i} ofword{i}" for i in range(20)]
    assert encoder.encode(part) == [packed(library_ids(library, t)) for t in part]


def test_words_between_signs_are_learnt_once(library):
    encoder = huffman.LibraryEncoder(PATH)
    part = ["Unheard, unheard. (unheard) unheard!", "unheard's don'test ''s ('s x'd x' 'll 12a3", "É ñ-unheard's\u00a0b\t\nc"]
    given = []
    ids = encoder._ids
    encoder._ids = lambda texts, *more: given.extend(texts) or ids(texts, *more)
    assert encoder.encode(part) == [packed(library_ids(library, t)) for t in part]
    assert " ".join(given).split().count("unheard") == 1 and "unheard," not in " ".join(given).split()
    given.clear()
    assert encoder.encode(["unheard"] + part) == [packed(library_ids(library, t)) for t in ["unheard"] + part]
    assert not given


def test_token_files_read_back(spark, docs, empty, library, tmp_path):
    folder = str(tmp_path / "files")
    huffman.write_ids(docs, folder, PATH, end_id=2)
    rows = sorted(huffman.read_ids(spark, folder).collect(), key=lambda r: r["start"])
    text_of = {r["doc_id"]: r["text"] for r in docs.collect()}
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in rows]
    assert keys == sorted(keys) and len(rows) == docs.count()
    stream = []
    for row in rows:
        assert row["start"] == len(stream)
        assert row["ids"] == library_ids(library, text_of[row["doc_id"]]) + [2]
        stream += row["ids"]
    for row in huffman.read_ids(spark, folder, digests=True).collect():
        part = stream[row["start"] : row["start"] + row["n_tokens"]]
        assert row["ids_crc32"] == zlib.crc32(packed(part))
    parts = sorted(huffman.read_range(spark, folder, 300, 21000).collect())
    assert [i for p in parts for i in p["ids"]] == stream[300:21000]
    huffman.write_ids(empty, f"{folder}-empty", PATH, end_id=2)
    assert huffman.read_ids(spark, f"{folder}-empty").count() == 0


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(prints):
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
    label = np.arange(len(prints))
    while True:
        lower = np.array([label[row].min() for row in near])
        if (lower == label).all():
            return label
        label = lower


def test_simhash_near_duplicates(spark, docs, empty):
    rows = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    seen = {r["doc_id"]: r["text"] for r in docs.where("doc_id is not null").collect()}
    ids = sorted(seen)
    prints = np.array([brute_fingerprint(seen[i]) for i in ids], dtype=np.uint64)
    root = brute_roots(prints)
    for at, i in enumerate(ids):
        assert rows[i]["fingerprint"] == f"{int(prints[at]):016x}"
        assert rows[i]["component_id"] == ids[root[at]]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    with_null = set(root)  # the row without id has words of its own
    assert kept.count() == len(with_null) + 1
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_fingerprint_links_by_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    more = [b ^ np.uint64(sum(1 << int(i) for i in rng.choice(64, rng.integers(0, 5), replace=False))) for b in rng.choice(base, 300)]
    prints = np.unique(np.concatenate((base, np.array(more, dtype=np.uint64))))
    df = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long")
    got = {r["node"]: r["root"] for r in simhash.fingerprint_components(df).collect()}
    root = brute_roots(prints)
    groups = {}
    for x, r in zip(prints.view(np.int64).tolist(), root):
        groups.setdefault(int(r), set()).add(got.get(x, x))
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


def test_long_lists_give_the_same_links_as_short_ones(monkeypatch):
    rng = np.random.default_rng(4)
    members = np.unique(rng.integers(0, 1 << 24, 700).astype(np.uint64))
    short = simhash.list_components(members, (0, 1, 2))
    monkeypatch.setattr(simhash, "PAIRS_UP_TO", 10)
    assert (simhash.list_components(members, (0, 1, 2)) == short).all()


def test_keep_one_keeps_the_first_of_each_component(spark):
    rnd, made = random.Random(8), []
    for _ in range(25):
        base = [f"w{rnd.randrange(4000)}" for _ in range(rnd.choice([6, 60, 400]))]
        for edits in (0, 0, 1, 1, 2, 5):
            words = list(base)
            for _ in range(edits):
                words[rnd.randrange(len(words))] = f"x{rnd.randrange(4000)}"
            made.append(" ".join(words))
    root = brute_roots(np.array([brute_fingerprint(t) for t in made], dtype=np.uint64))
    rows = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string").repartition(5)
    kept = sorted(r["doc_id"] for r in simhash.keep_one(rows.union(rows)).collect())
    assert kept == sorted(set(root.tolist())) and len(kept) < len(made)


LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def labelled(spark):
    rnd, rows, labels = random.Random(2), [], []
    plain = ["river", "stone", "cloud", "garden", "women", "men", "walked", "over", "under", "the"]
    for i in range(600):
        words = rnd.choices(plain, k=40)
        toxic, good = i % 5 == 0, i % 4 != 0
        if toxic:
            words[rnd.randrange(40)] = rnd.choice(["scum", "idiots"])
        text = " ".join(words) + ". " if good else " ".join(w.upper() + "!!" for w in words)
        rows.append((i, text, "en", "s", 1, "x", 0, "y"))
        labels.append((i, int(good), int(toxic)))
    rows += [(None, "the river", "en", "s", 1, "x", 0, "y"), (9000, None, "en", "s", 1, "x", 0, "y"), (9001, "", None, None, 1, "x", 0, "y")]
    labels += [(None, 1, 0), (5, None, None), (77777, 1, 0), (3, 1, 0)]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)


@pytest.mark.parametrize("module, label, every, out", [(toxicity, "toxic", 3, 1), (quality, "quality", 4, 2)])
def test_classifiers_hold_out_and_handle_odd_rows(spark, labelled, empty, module, label, every, out):
    docs, labels = labelled
    model = module.train(docs, labels)

    def scored(frame):
        column = module.score_column(*((spark,) if module is quality else ()), model, frame["text"])
        return frame.select("doc_id", column.alias("p")).collect()

    truth = {r["doc_id"]: r[label] for r in labels.collect() if r[label] is not None and r["doc_id"] is not None}
    held = [(truth[r["doc_id"]], r["p"]) for r in scored(docs) if r["doc_id"] in truth and zlib.crc32(str(r["doc_id"]).encode()) % every == out]
    assert np.mean([(p >= 0.7) == y for y, p in held]) > 0.95 and len(held) > 100
    assert all(0 <= r["p"] <= 1 for r in scored(docs))
    assert scored(empty) == []
    nothing = module.train(docs, labels.limit(0))
    column = module.score_column(*((spark,) if module is quality else ()), nothing, docs["text"])
    assert docs.select(column.alias("p")).distinct().count() == 1


def test_naming_a_group_moves_the_score_less_when_regularised():
    names = ["women", "men", "bad"]
    rows = [[0]] * 30 + [[0, 2]] * 30 + [[1]] * 60
    y = np.array([0.0] * 30 + [1.0] * 30 + [0.0] * 60)
    pairs = [([0], [1])] * 10
    free, _ = toxicity.fit(names, rows, y, [])
    held, _ = toxicity.fit(names, rows, y, pairs)
    assert abs(held[0] - held[1]) < abs(free[0] - free[1]) / 2
    swapped = toxicity.sentences_with_groups("The Women came. Rain.", ("women", "men"))
    assert swapped == [("The Women came.", "The men came.")]


def brute_chat(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in groups.items():
        turns.sort()
        whole = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        loss = "".join(x for *_, r, x in turns if r.lower() == "assistant")
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("history", [0, 8, 40])
def test_chat_windows(spark, history):
    rnd, rows = random.Random(history), []
    odd = [None, "", "<|end|>", "&lt;<|assistant|>", "</s>[INST] ok [/INST]", "\\ é😀 &amp;", "|>x|>\n"]
    for conv in (None, 1, 2, 3, 4):
        for k in range(rnd.choice([1, 2, 9, 40])):
            role = rnd.choice(["user", "assistant", "assistant", None, "a|>b<|end|>", ""]) if k else "system"
            rows.append((conv, rnd.choice([k, k, None]), role, rnd.choice([*odd, "a b " * rnd.randint(1, 90)])))
    rows.append(rows[-1])
    turns = spark.createDataFrame([(*r, "extra", 1) for r in rows], "conv_id long, turn long, role string, text string, window string, pos int")
    made = chat.windows(turns, budget=100, history=history)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.digests(made).collect()}
    assert got == brute_chat(rows)
    for w in made.collect():
        assert w["context_turns"] <= w["formatted"].count("<|end|>")
    assert chat.digests(chat.windows(turns.limit(0))).count() == 0


def test_chat_repeats_history_and_system_turn(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, k, "user" if k % 2 else "assistant", "w " * 20 + str(k)) for k in range(1, 13)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = sorted(chat.windows(turns, budget=120, history=30).collect(), key=lambda w: w["window"])
    assert len(made) > 2 and all(w["formatted"].startswith("<|system|>be kind<|end|>") for w in made)
    assert made[0]["context_turns"] == 0 and all(w["context_turns"] == 2 for w in made[1:])
    assert sum(len(w["loss"]) for w in made) == 6


def chat_cost(formatted):
    """What the turns of a window cost, from its text."""
    return [
        len(re.findall(r"[^\W_]+|[^\s\w]|_", t.replace("&lt;", "<").replace("&amp;", "&"))) + chat.TURN_TOKENS
        for t in re.findall(r"<\|[^|]*\|>([^<]*)<\|end\|>", formatted)
    ]


@pytest.mark.parametrize("budget, history", [(1024, 256), (100, 0), (60, 30)])
def test_windows_keep_their_budget(spark, budget, history):
    rnd = random.Random(budget)
    rows = [(1, i, "user", "w " * n) for i, n in enumerate((50, 600, 50, 600))]
    for c in range(2, 30):
        rows += [(c, 0, "system", "s " * rnd.randint(0, 20))] if c % 3 else []
        rows += [(c, i + 1, ("user", "assistant")[i % 2], "x, " * int(rnd.expovariate(1 / 20))) for i in range(rnd.randint(0, 60))]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    made = chat.windows(turns, budget=budget, history=history).collect()
    texts = {}
    for w in made:
        costs = chat_cost(w["formatted"])
        system = w["formatted"].startswith("<|system|>")
        own = len(costs) - w["context_turns"] - (system and w["context_turns"] == 0)
        repeated = w["context_turns"] - (system and w["context_turns"] > 0)
        assert sum(costs) <= budget or (own == 1 and repeated == 0)
        assert sum(costs[int(system) : int(system) + repeated]) <= history
        texts.setdefault(w["conv_id"], []).append((w["window"], own))
    counted = {c: sum(1 for r in rows if r[0] == c and r[2] != "system") for c in {r[0] for r in rows}}
    assert all(sum(n for _, n in found) == counted[c] for c, found in texts.items() if counted[c])
    assert any(w["context_turns"] > 1 for w in made) or history == 0


def test_main_text(spark):
    prose = "The cat is on the mat and it was there for all of the day. " * 6
    page = (
        "<html><head><title>T</title><script>var t='</p>';</script></head><body><nav><a href=x>Menu</a></nav>"
        f"<div class='ad'>{prose}</div><article><h1>A &amp; B</h1><p>{prose}<br>x &lt;\n b<p>one | two<div class=comments>{prose}</div>"
        "</article><footer>&copy; f</footer>"
    )
    assert html_text.main_text(page) == f"A & B\n\n{prose}x < b\n\none | two"
    loose = f"<div class=menu>Home</div><div><p>{prose}</p><p>Short.</p><p>{prose}</p></div><p><a href=a>All of the links here</a></p>"
    assert html_text.main_text(loose) == f"{prose.strip()}\n\nShort.\n\n{prose.strip()}"
    assert html_text.main_text("<article><p>cut <b") == "cut"
    rows = [(1, "u", page, "t"), (1, "u", page, "t"), (2, None, None, "t"), (None, "v", "", "t"), (3, "w", "<" * 9000, "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extract(pages).collect()
    assert sorted(r["n_chars"] for r in got if r["page_id"] == 1) == [len(html_text.main_text(page))] * 2
    assert [r["text"] for r in got if r["page_id"] in (2, None)] == ["", ""]
    assert html_text.extract(pages.limit(0)).count() == 0


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    made = rng.normal(size=(1500, 16)).astype(np.float32)
    made[100:400] = made[20]  # many equal vectors
    rows = [(i, v.tolist(), "x") for i, v in enumerate(made)]
    rows += [(1600, None, "x"), (1620, [1.0], "x"), (1640, [float("nan")] * 16, "x"), (1660, [None] * 16, "x"), (None, made[0].tolist(), "x"), (1680, [0.0] * 16, "x")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string").repartition(4), made


def test_tree_search_recall_and_ties(vectors):
    df, made = vectors
    got = {}
    for r in kmeans_tree.nearest(df).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    x = made.astype(np.float64)
    hits = []
    for q in range(0, 1500, 20):
        scores = (x * x[q]).sum(axis=1)
        true = [i for i in np.lexsort((np.arange(1500), -scores)) if i != q][:20]
        rows = sorted(got[q])
        assert [r[0] for r in rows] == list(range(1, 21)) and all(abs(r[2] - scores[r[1]]) < 1e-12 for r in rows)
        assert [r[1] for r in rows] == sorted((r[1] for r in rows), key=lambda i: (-scores[i], i))
        hits.append(len({r[1] for r in rows} & set(true)) / 20)
    assert set(got) == set(range(0, 1500, 20)) and np.mean(hits) >= 0.9
    assert kmeans_tree.nearest(df.limit(0)).count() == 0


@pytest.mark.parametrize("copies", [2, 30])
def test_tree_search_with_every_row_repeated(spark, copies):
    x = np.random.default_rng(6).normal(size=(60, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x) for _ in range(copies)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in kmeans_tree.nearest(frame, recall=1.0).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    for at in range(0, 60, 20):
        true = [int(i) for i in np.argsort(-(x @ x[at])) if i != at][:20]
        assert [got[at][rank] for rank in range(1, 21)] == true


def test_tree_search_fills_k_places_from_small_leaves(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 8)) * 50
    made = [c + rng.normal(size=8) * 0.01 for c in centres for _ in range(100)]
    for i in (0, 400, 800):  # lone outliers among the queries
        made[i] = np.eye(8)[i // 400] * -1000.0
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(made)], "vec_id long, embedding array<double>")
    got = {}
    for r in kmeans_tree.nearest(frame, recall=0.01).collect():  # one leaf by calibration
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert all(len(got.get(i, ())) == 20 for i in range(0, 1200, 20))


def test_top_products_are_exact(vectors, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 200)
    df, made = vectors
    got = {}
    for r in topk.top_products(df).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    z = np.floor(64 * made.astype(np.float64)).astype(np.int64)
    z = np.concatenate((z, np.zeros((1, 16), dtype=np.int64)))
    ids = np.append(np.arange(1500), 1680)
    for at in (*range(0, 1500, 20), 1500):
        scores = z @ z[at]
        true = [i for i in np.lexsort((ids, -scores)) if i != at][:20]
        assert sorted(got[int(ids[at])]) == [(k + 1, int(ids[i]), int(scores[i])) for k, i in enumerate(true)]
    assert len(got) == 76 and topk.top_products(df.limit(0)).count() == 0


@pytest.mark.parametrize("copies", [2, 30])
def test_top_products_with_every_row_repeated(spark, monkeypatch, copies):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 200)
    z = np.random.default_rng(2).integers(-9, 10, (120, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(z.astype(float)) for _ in range(copies)]
    got = {}
    for r in topk.top_products(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), scale=1).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for at in range(0, 120, 20):
        scores = z @ z[at]
        true = [i for i in np.lexsort((np.arange(120), -scores)) if i != at][:20]
        assert sorted(got[at]) == [(k + 1, int(i), int(scores[i])) for k, i in enumerate(true)]


@pytest.mark.parametrize("size", [1e9, 1e12])
def test_top_products_of_large_components(spark, size):
    z = np.random.default_rng(3).normal(size=(90, 5)) * size
    rows = [(i, v.tolist()) for i, v in enumerate(z)] + [(500, [1e300] * 5)]  # passes 2^53 once scaled
    ints = [[int(np.floor(64 * x)) for x in v] for v in z]
    got = {}
    for r in topk.top_products(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q in range(0, 90, 20):
        true = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in enumerate(ints) if i != q)[:20]
        fits = [(k + 1, i, -s if abs(s) < 1 << 63 else None) for k, (s, i) in enumerate(true)]
        assert sorted(got[q]) == fits


def test_articles_around_the_story_do_not_replace_it():
    story = "It was the best of the times and it was the worst of them, and so on and on for all of us. " * 5
    for page in (
        f"<div id=story><p>{story}</p></div><aside><article>teaser</article></aside>",
        f"<div id=story><p>{story}</p></div><article class=comment><p>{story[::-1]}</p></article>",
        f"<article></article><div><p>{story}</p></div>",
    ):
        assert html_text.main_text(page) == story.strip()


def test_deeply_nested_pages_take_linear_time():
    page = "<div>" * 20_000 + "<p>some words of a story that goes on</p>" + "</p></b>" * 20_000
    start = time.process_time()
    assert [b.text for b in html_text.cut(page)] == ["some words of a story that goes on"]
    assert time.process_time() - start < 5


def test_mix_meets_its_targets(spark, docs, empty):
    made = mixing.mix_sources(docs)
    rows = made.collect()
    again = mixing.mix_sources(docs.repartition(5)).collect()
    assert len(rows) == docs.count() and sorted(rows, key=str) == sorted(again, key=str)
    words = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0d]+", r["text"] or "")) for r in docs.collect()}
    assert all(r["size"] == words[r["doc_id"]] and 0 <= r["taken"] <= 2 * r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    assert all(abs(sum(taken) - target) <= 1 for (_, target), taken in by.items())
    assert abs(sum(t for _, t in by) - 1.5 * sum(s for s, _ in by)) < 1e-6
    assert mixing.mix_sources(empty).count() == 0


def test_targets_by_brute_force(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, "d": 400, "e": 0}
    frame = spark.createDataFrame([("s" + k, v) for k, v in sizes.items()], "source_key string, source_size long")
    got = {r["source_key"]: r["target"] for r in mixing.source_targets(frame).collect()}
    weights = dict(zip(sorted(sizes), [3.0, 1.0, 2.0, 3.0, 1.0]))
    target, excess, full = {k: 0.0 for k in sizes}, 1.5 * sum(sizes.values()), set()
    while excess > 1e-9 and len(full) < len(sizes):
        total, spill = sum(w for k, w in weights.items() if k not in full), 0.0
        for k in [k for k in sizes if k not in full]:
            target[k] += excess * weights[k] / total
            if target[k] >= 2 * sizes[k]:
                spill += target[k] - 2 * sizes[k]
                target[k] = 2.0 * sizes[k]
                full.add(k)
        excess = spill
    assert all(abs(got["s" + k] - t) < 1e-6 for k, t in target.items())


def test_pipeline_stages_keep_columns_and_empty_tables(spark, labelled, tmp_path):
    docs, labels = labelled
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    now = spark.read.parquet(f"{folder}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in now.collect()}
    toxic = {r["doc_id"] for r in labels.where("toxic = 1").collect()}
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, folder)
        if number < 4:
            assert out.columns == docs.columns
            rows = out.collect()
            assert all(before[r["doc_id"]] == r["text"] for r in rows)
            if number == 0:
                assert not toxic & {r["doc_id"] for r in rows} and len(rows) >= 0.95 * (len(before) - len(toxic))
            out.write.parquet(f"{folder}/{number}")
            now = spark.read.parquet(f"{folder}/{number}")
        else:
            assert out.count() == now.count()
    assert [name for name, _ in corpus_pipeline.STAGES][2] == "SimHash near-dedup"
