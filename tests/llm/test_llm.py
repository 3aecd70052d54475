"""Encoding, packing and splitting: against the public libraries, round trips and invariants."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldloom.llm import encoder, lexicon, packing, pretokens, splitting
from fieldloom.session import materialize

PATH = lexicon.vocabulary_path()
TRUTH = tiktoken.Encoding("truth", pat_str=lexicon.PATTERN, mergeable_ranks=lexicon.ranks(PATH), special_tokens={})
TEXTS = [
    None, "", " ", "\n\n", "a", "don't we'll I'D they're 'tis x's's ''s 's", " 's 'rex  'v", "tab\t\tnew\r\n\r\nline  end  ", "naïve café — 東京、大阪。Ω ١٢٣ १२ ½", "a​b\xa0c　d", "x" * 5000, "ab " * 3000, "日本語" * 900,
    "{\"k\": [1, 2.5e3]}\n<p class='x'>t</p>", "🛫🛬 flags 🇫🇷 é", "\x00\x1c\x85end", "One. Two! Three?\n\nFour; five, six:\n- seven\n" * 200,
]


def coder(words=()):
    return encoder.Coder(encoder.Encoder("", PATH), lexicon.Lexicon(lexicon.compile_lexicon({w: lexicon.merge(w, PATH) for w in words})))


def ids_of(texts, c):
    w = pretokens.split(pa.array(texts, pa.string()))
    counts, ids = c.encode(w)
    at = np.concatenate([[0], np.cumsum(counts)])[w.first]
    return [ids[a:b].tolist() for a, b in zip(at, at[1:])]


PIECES = st.lists(st.sampled_from(["'s", "'", "'ll", " ", "  ", "\n", "\t", "a", "Re", "9", "é", "日", ".", "—", "\xa0", "🛫", "'T", "l", "x1"]), max_size=30).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(PIECES, st.text(max_size=40)), max_size=6))
def test_pretokens_are_the_pattern_s(texts):
    w = pretokens.split(pa.array(texts, pa.string()))
    got = [[w.word(j) for j in range(a, b)] for a, b in zip(w.first, w.first[1:])]
    assert got == [[x.encode() for x in regex.findall(lexicon.PATTERN, t)] for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(PIECES, max_size=5))
def test_ids_don_t_depend_on_the_lexicon(texts):
    want = [TRUTH.encode_ordinary(t) for t in texts]
    assert ids_of(texts, coder()) == want == ids_of(texts, coder([b" ", b"a", b"'s", b"\n", " é".encode(), b"Re"]))


def test_other_vocabulary_and_library():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(PATH.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    texts = [x for x in TEXTS if x]
    assert ids_of(texts, coder([b" two", b" six"])) == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_transducer_is_minimal_and_numbers_words_in_order():
    r = random.Random(1)
    words = {bytes(r.choices(b"abc", k=r.randrange(1, 8))) for _ in range(800)} | {b"\xff\x00", b"\x00"}
    lex = lexicon.Lexicon(lexicon.compile_lexicon({w: [i, i + 1][: 1 + i % 2] for i, w in enumerate(sorted(words))}))
    probe = sorted(words) + [w + b"c" for w in words if w + b"c" not in words] + [b"", b"zz"]
    data = np.frombuffer(b"".join(probe), np.uint8)
    ends = np.cumsum([len(w) for w in probe])
    n = lex.numbers(data, np.concatenate([[0], ends[:-1]]), ends)
    assert n[: len(words)].tolist() == list(range(len(words))) and (n[len(words) :] == -1).all()
    assert [lex.ids[lex.offsets[i] : lex.offsets[i + 1]].tolist() for i in range(4)] == [[0], [1, 2], [2], [3, 4]]
    # suffixes are shared: a trie of these words has a state for each prefix
    assert len(lex.base) < len({w[:k] for w in words for k in range(len(w) + 1)}) / 2
    assert len(lexicon.Lexicon(lexicon.compile_lexicon({}))) == 0


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["a", "b", None][i % 3], "clash") for i, t in enumerate(TEXTS * 2)] + [(None, "no key", "a", "c"), (5, TEXTS[5], "a", "c")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, ids string")


@pytest.fixture(scope="module")
def fitted(spark, docs):
    return encoder.fit(spark, docs, "doc_id", "text", sample=10, words=50)


def test_encode(spark, docs, fitted):
    got = sorted((tuple(r) for r in encoder.encode(docs, "doc_id", "text", fitted).collect()), key=repr)
    assert got == sorted(((r["doc_id"], TRUTH.encode_ordinary(r["text"] or "")) for r in docs.collect()), key=repr)
    assert encoder.encode(docs.limit(0), "doc_id", "text", fitted).count() == 0
    assert encoder.fit(spark, docs.limit(0), "doc_id", "text")


def test_decoding_gives_the_texts_back(spark, docs, fitted):
    ids = encoder.encode(docs, "doc_id", "text", fitted).unionAll(spark.createDataFrame([(99, None)], "doc_id bigint, ids array<int>"))
    got = sorted((tuple(r) for r in encoder.decode(ids, "doc_id", "ids", PATH).collect()), key=repr)
    assert got == sorted([(r["doc_id"], r["text"] or "") for r in docs.collect()] + [(99, None)], key=repr)


def test_words_of_all_documents_are_counted(spark, monkeypatch):
    """However many documents there are, and however often a task hands on what it has counted."""
    monkeypatch.setattr(encoder, "COUNTED_WORDS", 500)
    letters = F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")
    docs = spark.range(9000).select(F.col("id").alias("doc_id"), F.concat(F.lit("n"), letters, F.lit(" often")).alias("text"))
    lex = encoder._lexicon(encoder.fit(spark, docs, "doc_id", "text").file)
    probe = [b"n" + str(i).translate(str.maketrans("0123456789", "abcdefghij")).encode() for i in range(9000)]
    ends = np.cumsum([len(w) for w in probe])
    assert len(lex) == 9001 and (lex.numbers(np.frombuffer(b"".join(probe), np.uint8), ends - [len(w) for w in probe], ends) >= 0).all()
    top = encoder._lexicon(encoder.fit(spark, docs, "doc_id", "text", words=1).file)
    assert len(top) == 1 and top.ids.tolist() == lexicon.merge(b" often", PATH)


def test_word_counts_of_odd_texts():
    counted = encoder._summed([encoder._word_counts(pa.array(TEXTS[k:], pa.string()).slice(1)) for k in (0, 3)])
    want = Counter(x.encode() for k in (1, 4) for t in TEXTS[k:] for x in regex.findall(lexicon.PATTERN, t or ""))
    assert dict(zip(*counted.to_pydict().values())) == {w: n for w, n in want.items() if len(w) <= encoder.LONGEST_WORD}


def test_the_sample_is_bounded_when_one_text_repeats(spark):
    """A text that half the corpus repeats is in the sample in proportion, not always or never."""
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "same words here").otherwise(F.concat(F.lit("w"), "id")).alias("text"))
    words = encoder.fit(spark, docs, "doc_id", "text", sample=200, words=10_000)
    lex = encoder._lexicon(words.file)
    assert 60 < len(lex) < 180


def sizes_of(spark, sizes):
    return materialize(spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(sizes)], "doc_id bigint, source string, n_tokens bigint"))


@pytest.mark.parametrize("mixture", [None, {"hot": 0.5, "gone": 0.2}, {"s1": 1.0}])
def test_packing(spark, mixture):
    r = random.Random(4)
    sizes = [("hot" if r.random() < 0.4 else f"s{r.randrange(6)}", r.choice([0, 1, 5, 30, 60, 99, 100, 101, 250, 1000])) for _ in range(3000)] + [(None, 7), (None, None), ("hot", 100)]
    cap = 100
    packed = packing.pack(sizes_of(spark, sizes), "doc_id", "source", "n_tokens", cap, mixture, 20)
    rows = packed.collect()
    by, used = {}, {}
    for x in rows:
        by.setdefault(x["doc_id"], []).append(x)
        used[x["container_id"]] = used.get(x["container_id"], 0) + x["n_tokens"]
    assert len(by) == len(sizes) and max(used.values()) <= cap
    for i, (s, n) in enumerate(sizes):
        own = sorted(by[i], key=lambda x: x["piece_no"])
        assert sum(x["n_tokens"] for x in own) == (n or 0) and own[0]["source"] == s
        assert len(own) == max(1, -(-(n or 0) // cap)) and [x["start_token"] for x in own] == [k * cap for k in range(len(own))]
    total = sum(n or 0 for _, n in sizes)
    pieces = [min(cap, (n or 0) - k * cap) for _, n in sizes for k in range(max(1, -(-(n or 0) // cap)))]
    windows = len({x["window_no"] for x in rows})
    assert len(used) <= 1 + max(packing.best_fit([x for x in pieces if x], cap)) + windows  # a window leaves one container open, at most
    f = packing.fill(packed, cap).first()
    assert (f["containers"], f["tokens"], f["fullest"]) == (len(used), total, cap)


def test_windows_keep_the_mixture(spark):
    r = random.Random(5)
    sizes = [(r.choices(["a", "b", "c"], [6, 3, 1])[0], r.randrange(1, 40)) for _ in range(6000)]
    total = {s: sum(n for x, n in sizes if x == s) for s in "abc"}
    seen = {}
    for x in packing.pack(sizes_of(spark, sizes), "doc_id", "source", "n_tokens", 100, None, 50).collect():
        seen.setdefault(x["window_no"], {}).setdefault(x["source"], []).append(x["n_tokens"])
    whole = sum(total.values())
    served = dict.fromkeys("abc", 0)
    for k in sorted(seen):
        for s in "abc":
            served[s] += sum(seen[k].get(s, []))
            target = whole * (k + 1) / len(seen) * total[s] / whole
            assert abs(served[s] - target) <= 40  # the deficit carried on is less than one item


def test_deficits_are_carried_and_stay_below_an_item(spark):
    """With an explicit mixture: each window gives a source what it is due, short of less than an item, until its queue is empty."""
    r = random.Random(6)
    sizes = [(r.choices(["a", "b", "c", None], [6, 3, 1, 1])[0], r.randrange(0, 40)) for _ in range(6000)]
    mixture = {"a": 0.2, "b": 0.5, "gone": 0.1}
    packed = materialize(packing.pack(sizes_of(spark, sizes), "doc_id", "source", "n_tokens", 100, mixture, 20))
    rows = packing.balance(packed, "source", mixture).collect()
    windows = 1 + max(x["window_no"] for x in rows)
    assert len(rows) == 4 * windows and sum(x["n_tokens"] for x in rows) == sum(n for _, n in sizes)
    by = {}
    for x in sorted(rows, key=lambda x: x["window_no"]):
        by.setdefault(x["queue"], []).append(x)
    for q, own in by.items():
        sources = 2 if q == "rest" else 1
        assert all(abs(x["deficit"]) <= 40 * sources for x in own) and abs(own[-1]["deficit"]) < 1e-6
        short = 0.0
        for x in own:
            short += x["target"] - x["n_tokens"]
            assert abs(short - x["deficit"]) < 1e-6
    early = [x for x in rows if x["window_no"] == 0]
    share = {x["queue"]: x["target"] / sum(y["target"] for y in early) for x in early}
    assert share["gone"] == 0 and abs(share["b"] / share["a"] - 2.5) < 1e-9
    assert packing.balance(packed.limit(0), "source", mixture).count() == 0


def test_packing_of_nothing(spark):
    none = sizes_of(spark, [("a", 1)]).limit(0)
    assert packing.pack(none, "doc_id", "source", "n_tokens", 10).count() == 0
    only_empty = packing.pack(sizes_of(spark, [("a", 0), (None, None)]), "doc_id", "source", "n_tokens", 10)
    assert sorted(r["n_tokens"] for r in only_empty.collect()) == [0, 0]
    with pytest.raises(ValueError):
        packing.pack(none, "doc_id", "source", "n_tokens", 0)


def check_pieces(text, own, limit, overlap):
    want = TRUTH.encode_ordinary(text or "")
    if len(want) <= limit:
        assert len(own) == 1 and own[0]["text"] == text and own[0]["n_tokens"] == len(want)
        return
    assert own[0]["start_char"] == 0 and own[-1]["end_char"] == len(text) and len(own) >= 1 + -(-(len(want) - limit) // (limit - overlap))
    for k, p in enumerate(own):
        assert p["piece_no"] == k and p["n_pieces"] == len(own) and p["text"] == text[p["start_char"] : p["end_char"]]
        assert p["n_tokens"] == len(TRUTH.encode_ordinary(p["text"])) <= limit
        if k:
            a, b = own[k - 1], p
            assert a["start_char"] < b["start_char"] <= a["end_char"] < b["end_char"]
            if overlap:
                assert b["start_char"] < a["end_char"]
            else:
                assert b["start_char"] == a["end_char"]


@pytest.mark.parametrize("limit,overlap", [(64, 0), (64, 8), (200, 50), (1024, 64)])
def test_splitting(docs, fitted, limit, overlap):
    by = {}
    for r in splitting.split_documents(docs.where("doc_id is not null").dropDuplicates(["doc_id"]), "doc_id", "text", fitted, limit, overlap).collect():
        by.setdefault(r["doc_id"], []).append(r)
    assert len(by) == 2 * len(TEXTS)
    for i, own in by.items():
        check_pieces((TEXTS * 2)[i], sorted(own, key=lambda r: r["piece_no"]), limit, overlap)


def test_pieces_are_added_in_few_rounds(fitted, monkeypatch):
    """Where limits fail again and again, the number of pieces tried grows by doubling, and the least found that holds is kept."""
    text = ("abc " * 400).encode()
    w = pretokens.split(pa.array([text.decode()]))
    c = coder()
    counts, ids = c.encode(w)
    tries, plain = [], splitting.cut

    def fails(tokens, strong, limit, overlap, extra=0):
        tries.append(extra)
        return plain(tokens, strong, limit, overlap, extra) if extra >= 37 else None

    monkeypatch.setattr(splitting, "cut", fails)
    got = splitting.pieces(w.data, w.edges, counts, ids, c, 100, 10)
    least = 1 + -(-(int(counts.sum()) - 100) // 90)
    assert len(got) == least + 37 and len(tries) < 20


def test_splitting_prefers_natural_ends(spark, fitted):
    text = "\n\n".join(" ".join(f"word{i}x{j} is here." for j in range(10)) for i in range(30))
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    own = sorted(splitting.split_documents(df, "doc_id", "text", fitted, 300, 20).collect(), key=lambda r: r["piece_no"])
    assert len(own) > 3 and all(p["text"].endswith((".", "\n\n")) for p in own[:-1])
    two = sorted(splitting.split_documents(df, "doc_id", "text", fitted, 1500, 20).collect(), key=lambda r: r["piece_no"])
    assert len(two) == 2 and two[0]["text"].endswith("\n\n")  # with room to choose, a paragraph's end


def test_splitting_without_texts_and_bad_parameters(docs, fitted):
    short = splitting.split_documents(docs, "doc_id", "text", fitted, 64, 8, False)
    assert short.count() == splitting.split_documents(docs, "doc_id", "text", fitted, 64, 8).count()
    found = {r[0] for r in short.where("n_pieces > 1").select("doc_id").collect()}
    assert found == {r["doc_id"] for r in docs.collect() if len(TRUTH.encode_ordinary(r["text"] or "")) > 64}
    assert splitting.split_documents(docs.limit(0), "doc_id", "text", fitted, 64, 8).count() == 0
    with pytest.raises(ValueError):
        splitting.split_documents(docs, "doc_id", "text", fitted, 8, 8)


def test_queries(spark):
    from fieldloom.llm.queries import QUERIES

    d = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{d}/documents.parquet").count()
    assert QUERIES["p6_ids"](spark, d).select(F.countDistinct("doc_id")).first()[0] == n
    assert QUERIES["p7_fill"](spark, d).first()["fullest"] <= 2048
    assert QUERIES["p8_found"](spark, d).columns == ["doc_id"]
