"""Token alignment, hard negatives and encoding by chunks against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starweir.llm import alignment, negatives, quality, queries, reuse
from starweir.llm.shipping import ship
from starweir.llm.text import LONG_BYTES, utf8, words_of
from starweir.llm.tokens import encoder, vocabulary_path

QUERIES = {name.split("_")[0]: query for name, query in queries.queries().items()}
A, B = queries.BYTE_VOCABULARY, queries.PIECE_VOCABULARY
WORDS = queries.WORD_VOCABULARY


@pytest.fixture(autouse=True, scope="module")
def shipped(spark):
    ship(spark)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def thue_morse(n, one="a", other="b"):
    return "".join(one if bin(i).count("1") % 2 == 0 else other for i in range(n))


ODD_TEXTS = [
    None, "", " ", "\n", "a", "word", " begins blank", "ends blank ", "two  blanks  here", "tab\tand\nline\n\n end",
    "snow ☃ and 日本語のテキスト", "▁lower one eighth block", "<|endoftext|> is text", "<s> </s> <0x41>",
    "é" * 300, "x" * 5000, thue_morse(2048), thue_morse(2048, "b", "a"), "it's we'll I'd", "nbsp here　too",
    "same words again and again " * 400, "same words again and again " * 400, "1234567890 3.14 #tag @you",
    "zero\x00byte", "mixed   separators \x85 too", "a" + " b" * 900,
]


def frame(spark, texts):
    rows = [(i if i % 5 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return rows, df.withColumns({c: F.lit("x") for c in ("ids", "decoded", "groups", "key", "task", "n")})


# Two hashes --------------------------------------------------------------------------


@pytest.mark.parametrize("length", [LONG_BYTES, 1024, 2048])
def test_unlike_long_words_are_told_apart(length):
    texts = [thue_morse(length), thue_morse(length, "b", "a"), thue_morse(length)]
    data, bounds = utf8(pa.array(texts))
    one, two, three = words_of(data, bounds).hashes().tolist()
    assert one == three != two


@pytest.mark.parametrize("vocabulary", [WORDS, A])
def test_ids_of_unlike_long_words(vocabulary):
    texts = [thue_morse(2048), thue_morse(2048, "b", "a"), "and " + thue_morse(1024, "b", "a")]
    ids, bounds = encoder(vocabulary).encode(pa.array(texts))
    plain = Tokenizer.from_file(vocabulary_path(vocabulary))
    for text, low, high in zip(texts, bounds[:-1], bounds[1:]):
        assert ids[low:high].tolist() == plain.encode(text, add_special_tokens=False).ids


def test_cached_pieces_of_one_hash_are_told_apart():
    own = type(encoder(WORDS))(vocabulary_path(WORDS))
    own.encode(pa.array(["first word"]))
    own.checks[:] ^= np.uint64(1)
    ids, _ = own.encode(pa.array(["first word"]))
    plain = Tokenizer.from_file(vocabulary_path(WORDS))
    assert ids.tolist() == plain.encode("first word", add_special_tokens=False).ids


def test_repeated_long_lines_are_told_apart():
    text = "\n".join([thue_morse(2048), thue_morse(2048, "b", "a"), thue_morse(2048)])
    data, bounds = utf8(pa.array([text]))
    counts, _, _ = quality.count_chunk(data, bounds)
    assert counts["n_dup_lines"].tolist() == [1]


# Alignment ---------------------------------------------------------------------------


def aligned_by_hand(rows):
    """Every row's result, byte by byte and pair by pair."""
    import sentencepiece

    plain = Tokenizer.from_file(vocabulary_path(A))
    plain.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(B))
    value = {c: b for b, c in alignment.byte_characters().items()}
    held, counts = [], Counter()
    for doc, text in rows:
        whole = (" " + (text or "")).encode()
        a = [(i, bytes(value[c] for c in plain.id_to_token(i)))
             for i in plain.encode(" " + (text or ""), add_special_tokens=False).ids]
        b = [(i, bytes([int(pieces.id_to_piece(i)[1:-1], 16)]) if pieces.is_byte(i)
              else pieces.id_to_piece(i).replace("▁", " ").encode()) for i in pieces.encode(text or "")]
        if not text or any(b"".join(t for _, t in own) != whole for own in (a, b)):
            a, b = [], []
        owner_a = [n for n, (_, t) in enumerate(a) for _ in t]
        owner_b = [n for n, (_, t) in enumerate(b) for _ in t]
        links = sorted(set(zip(owner_a, owner_b)))
        groups, own_a, own_b = [], [], []
        for at, (x, y) in enumerate(zip(owner_a, owner_b)):
            own_a += [x] if x not in own_a[-1:] else []
            own_b += [y] if y not in own_b[-1:] else []
            if owner_a[at + 1 : at + 2] != [x] and owner_b[at + 1 : at + 2] != [y]:
                groups.append(",".join(str(a[i][0]) for i in own_a) + "|" + ",".join(str(b[i][0]) for i in own_b))
                own_a, own_b = [], []
        ids = [(a[x][0], b[y][0]) for x, y in links]
        counts.update(ids)
        held.append((doc, len(a), len(b), len(groups), ids, ";".join(groups)))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return sorted(
        (
            (doc, n_a, n_b, n_groups, len(ids), sum(counts[i] == best[i[1]] for i in ids),
             sum(counts[i] for i in ids), sha(groups) if groups else "")
            for doc, n_a, n_b, n_groups, ids, groups in held
        ),
        key=repr,
    )


COLUMNS = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


def digest(df):
    text = F.col("groups")
    return df.withColumn("groups_sha256", F.when(text == "", "").otherwise(F.sha2(text.cast("binary"), 256)))


@pytest.mark.parametrize(
    "rules",
    [
        alignment.AlignmentRules(),
        alignment.AlignmentRules(bucket_keys=50, sent_pairs=300, piece_counts=7, fan_in=2),
    ],
)
def test_alignment_of_odd_rows(spark, rules):
    rows, df = frame(spark, ODD_TEXTS)
    found = digest(alignment.align_documents(df, A, B, rules)).select(COLUMNS)
    assert sorted(map(tuple, found.collect()), key=repr) == aligned_by_hand(rows)


def test_alignment_of_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op11"](spark, sf_dir).select(COLUMNS).collect()
    assert sorted(map(tuple, found), key=repr) == aligned_by_hand(rows)


def test_alignment_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_documents(none, A, B).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 40_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 60, n))
    buckets = 1 + n // 1000
    own = alignment.bucket_of(keys, buckets)
    parts = [keys[own == i] for i in range(buckets)]
    known = alignment.PerfectHash([alignment.build_levels(p, 2.0) for p in parts], parts)
    assert sorted(known.places(keys).tolist()) == list(range(len(keys)))
    others = keys + 1
    others = others[~np.isin(others, keys)]
    assert (known.places(others) == -1).all()


# Hard negatives ----------------------------------------------------------------------


def mined_by_hand(rows, rules=negatives.NegativeRules()):
    ready = []
    for vec, v, label in rows:
        if label is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if vec is not None and vec % 7 == 0 else label
        ready.append((vec, [int(np.floor(256 * float(np.float32(x)))) for x in v], label))
    last = lambda i: (i is None, i or 0)
    out = []
    for at, (vec, v, label) in enumerate(ready):
        if vec is None or vec % rules.anchor_step:
            continue
        others = [
            (-sum(x * y for x, y in zip(v, w)), last(i), same == label)
            for n, (i, w, same) in enumerate(ready) if n != at and len(w) == len(v)
        ]
        ranked = sorted(others)
        for s, i, _ in [o for o in ranked if o[2]][: rules.positives]:
            able = [o for o in ranked if not o[2] and 80 * -s <= 100 * -o[0] <= 100 * -s]
            for rank, (t, j, _) in enumerate(able[: rules.negatives], 1):
                id_of = lambda k: None if k[0] else k[1]
                out.append((vec, id_of(i), rank, id_of(j), -s, -t))
    return sorted(out, key=repr)


def vectors(seed, n):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=6)
    rows = [(int(i), [float(np.float32(x)) for x in centre + rng.normal(size=6)], int(rng.integers(0, 3))) for i in range(n)]
    hot = [0.5] * 6
    rows += [(1000 + i, hot, i % 2) for i in range(n // 3)]
    rows += [(0, rows[0][1], 1), (100, hot, 1), (100, hot, 1), (None, hot, 1), (None, hot, 0), (7, None, 1)]
    rows += [(200, hot, None), (300, [0.1, None] + [0.2] * 4, 1), (400, [float("nan")] * 6, 1), (500, [], 1)]
    rows += [(600, [0.1, 0.2], 1), (601, [0.1, 0.3], 1), (602, [0.1, 0.2], 0), (700, [-x for x in hot], 2)]
    rows += [(800, [float("inf")] * 6, 0), (900, [0.0] * 6, 0), (901, [0.0] * 6, 0), (902, [0.0] * 6, 1)]
    return rows


@pytest.mark.parametrize("rules", [negatives.NegativeRules(), negatives.NegativeRules(anchor_bytes=200)])
def test_hard_negatives_of_odd_rows(spark, rules):
    rows = vectors(1, 330)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    df = df.withColumns({c: F.lit("x") for c in ("anchor", "place", "rank", "score", "slots")})
    found = negatives.hard_negatives(df, rules)
    assert found.columns == "anchor_id positive_id rank negative_id positive_score negative_score".split()
    assert sorted(map(tuple, found.collect()), key=repr) == mined_by_hand(rows)


def test_hard_negatives_of_embeddings(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    found = QUERIES["op12"](spark, sf_dir).collect()
    assert sorted(map(tuple, found), key=repr) == mined_by_hand([tuple(r) for r in table.collect()])


def test_hard_negatives_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert negatives.hard_negatives(none).collect() == []


# Encoding by chunks --------------------------------------------------------------------


def encoded_by_hand(rows):
    plain = Tokenizer.from_file(vocabulary_path(WORDS))
    out = []
    for doc, text in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids
        out.append((doc, ids, plain.decode(ids, skip_special_tokens=False)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(
    "rules",
    [
        reuse.ReuseRules(),
        reuse.ReuseRules(bits=3, least_bytes=32, most_bytes=64, dictionary_chunks=3, remembered_ids=50),
    ],
)
def test_encoding_of_odd_rows(spark, rules):
    rows, df = frame(spark, [*ODD_TEXTS, "<|startoftext|>joined<|endoftext|> Ünï Çødé ΑΣ ΑΣ. " * 60, "é日" * 900])
    found = reuse.encode_documents(df, WORDS, decoded=True, rules=rules).collect()
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in found), key=repr) == encoded_by_hand(rows)


def test_encoding_of_documents(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    expected = sorted(
        (doc, len(ids), sha(" ".join(map(str, ids))), sha(text))
        for doc, ids, text in encoded_by_hand([tuple(r) for r in table.collect()])
    )
    found = QUERIES["op13"](spark, sf_dir)
    columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, found.select(columns).collect())) == expected


def test_encoding_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert reuse.encode_documents(none, WORDS).collect() == []
    with pytest.raises(ValueError):
        reuse.encode_documents(none, A)


def test_a_passage_is_cut_alike_wherever_it_stands():
    rng = np.random.default_rng(3)
    passage = " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(3000))
    rules = reuse.ReuseRules()
    held = []
    for text in (passage, "something else before it, of any length " + passage):
        data, bounds = utf8(pa.array([text]))
        starts, ends, _ = reuse.cut(data, bounds, rules)
        assert starts[0] == 0 and ends[-1] == len(data) and (starts[1:] == ends[:-1]).all()
        held.append(set(reuse.digests_of(data, starts, ends)))
    assert len(held[0] & held[1]) >= 0.7 * len(held[0])
