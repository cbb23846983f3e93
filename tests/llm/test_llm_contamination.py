"""Benchmark items in documents against a plain version of the whole rule: every document
laid beside every item, without candidates, probes or hashes."""

import itertools
import math
import random
from collections import defaultdict

import regex
from pyspark.sql import functions as F

from starweir.llm import contamination as c
from starweir.llm import queries
from tests.llm.test_llm_operators import CLASHING, ITEM, WORD_PROBLEM, bag, sentence, with_values


def replaced(pattern, by, text):
    return regex.sub(pattern, by, text, flags=regex.ASCII)


def split(text):
    text = text.replace("#", "")
    return replaced(c._ATTACHED, " ", replaced(c._ORDINAL, "", text))


def words(text):
    for blank in c._BLANKS:
        text = text.replace(blank, " ")
    return [w for w in "".join(ch for ch in text if ch not in c._PUNCTUATION).lower().split(" ") if w]


def templates(text):
    text = replaced(c._MAYBE, c.MAYBE + r"\g<0>", replaced(c._NAME, c.NAME, split(text)))
    return words(replaced(c._UNIT, c.UNIT, replaced(c._NUMBER, c.NUMBER, text)))


def plain(word):
    return word.removeprefix(c.MAYBE)


def readings(word):
    return {plain(word), c.NAME} if word.startswith(c.MAYBE) else {word}


def counted(copy, is_plain, item, raw, item_raw, n):
    """(found, -changed, slots, consistent, windows) of one copy, or None if it is none."""
    windows = len(item) - n + 1
    found = {at for _, matched in copy for at in matched}
    if len(found) < math.ceil(windows * 0.8):
        return None
    values = []
    for p, word in enumerate(item):
        if word in (c.NUMBER, c.NAME, c.UNIT) or (not is_plain and word.startswith(c.MAYBE)):
            shift = next((s for s, matched in copy if any(at <= p < at + n for at in matched)), None)
            if shift is not None:
                values.append((item_raw[p], raw[p + shift], word.startswith(c.MAYBE)))
    keys = {a for a, b, maybe in values if not maybe or a != b}
    pairs = {(a, b) for a, b, _ in values}
    consistent = 0
    for key in keys:
        own = [b for a, b in pairs if a == key]
        consistent += len(own) == 1 and sum(b == own[0] for _, b in pairs) == 1
    if consistent < math.ceil(len(keys) * 0.8):
        return None
    return len(found), -sum(a != b for a, b in pairs), len(keys), consistent, windows


def window_texts(template, at, n, is_plain):
    window = template[at : at + n]
    return [tuple(map(plain, window))] if is_plain else itertools.product(*map(readings, window))


def places(template, n, is_plain):
    """Where each text of a window stands."""
    out = defaultdict(set)
    for at in range(len(template) - n + 1):
        for text in window_texts(template, at, n, is_plain):
            out[text].add(at)
    return out


def best_copy(placed, raw, item, item_raw):
    """The best of all ways to lay the item beside the document."""
    n = min(5, len(item))
    windows = len(item) - n + 1
    best = None
    for is_plain in (True, False):
        shifts = {}
        for item_at in range(windows):
            for text in window_texts(item, item_at, n, is_plain):
                for at in placed[n, is_plain].get(text, ()):
                    shifts.setdefault(at - item_at, set()).add(item_at)
        strong = [s for s, m in shifts.items() if len(m) >= 3 or 2 * len(m) >= windows]
        tries = [(s, [s]) for s in strong]
        near = lambda s, t: abs(s * 1000 // windows - t * 1000 // windows) <= 500
        tries += [(s, [t for t in shifts if near(s, t)]) for s in strong]
        if strong:
            tries.append((max(strong, key=lambda s: (len(shifts[s]), -s)), strong))
        for middle, held in tries:
            held = sorted(held, key=lambda t: (abs(t - middle), t))
            got = counted([(t, shifts[t]) for t in held], is_plain, item, raw, item_raw, n)
            best = max(best, got) if best and got else best or got
    return None if best and len(item) < 5 and best[1] else best


def brute(docs, items):
    items = {(i, t) for i, t in items if i is not None and t is not None}
    ready = [(i, templates(t), words(split(t))) for i, t in items]
    out = set()
    for doc_id, text in {d for d in docs if d[1] is not None}:
        doc, raw = templates(text), words(split(text))
        placed = {(n, p): places(doc, n, p) for n in range(1, 6) for p in (True, False)}
        for item_id, item, item_raw in ready:
            best = best_copy(placed, raw, item, item_raw) if item else None
            if best:
                found, same, slots, consistent, windows = best
                out.add((doc_id, item_id, windows, found, slots, consistent, -same))
    return bag(out)


COLUMNS = "doc_id item_id windows found slots consistent changed".split()


def found(spark, docs, items, rules=c.TemplateRules()):
    clash = {name: F.lit("x") for name in [*CLASHING, "windows", "item_id", "words", "length"]}
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns(clash).repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumns(
        {name: F.lit("x") for name in ("doc_id", "windows", "length", "hash", "tie")}
    )
    return bag(c.find_contaminated(df, benchmark, rules).select(*COLUMNS).distinct().collect())


def test_query_is_the_plain_rule(spark, sf_dir):
    rows = lambda t, *cols: [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{t}.parquet").select(*cols).collect()]
    want = brute(rows("documents", "doc_id", "text"), rows("benchmark", "item_id", "text"))
    got = queries.queries()["op10_template_decontamination"](spark, sf_dir).select(*COLUMNS)
    assert want and bag(got.collect()) == want


def changed_items(rng, item):
    """The item with words changed, dropped, put in and turned to other values."""
    parts = with_values(item, *rng.sample("Max Rosa Leo Ute 7 9 40 8".split(), 5)).split()
    for _ in range(rng.randrange(4)):
        at = rng.randrange(len(parts))
        parts[at : at + rng.randrange(2)] = rng.choice(([], ["extra"], ["Zoe"], ["17"], ["km"]))
    return " ".join(parts)


def test_odd_rows_are_the_plain_rule(spark):
    rng = random.Random(11)
    long_item = "One day " + sentence(rng, 30) + " and Bob paid 20 euros to Eve for 3 kg of tea."
    items = [(1, ITEM), (2, WORD_PROBLEM), (3, long_item), (4, None), (None, ITEM), (5, ""), (6, "?!"),
             (7, "Bob is here"), (8, "42"), (9, "12 34 56 78 90 12"), (9, "A B C D E F"), (1, ITEM)]
    base = [ITEM, WORD_PROBLEM, long_item]
    docs = [(i, f"{sentence(rng, 9)}. {changed_items(rng, rng.choice(base))} {sentence(rng, 9)}") for i in range(60)]
    docs += [(60, " ".join(changed_items(rng, t) for t in base * 3)), (61, None), (62, ""), (None, ITEM), (None, None)]
    docs += [(63, "so Bob is here now"), (64, "so Ann is here now"), (65, "it is 42, or 43"), (66, "is 43"),
             (67, "5 6 7 8 9 5"), (68, "5 6 7 8 9 6"), (69, "G H I J K L"), (70, ITEM), (70, ITEM), (70, WORD_PROBLEM)]
    docs += [(71, f"{ITEM} " * 200), (72, "bob is here"), (73, long_item.upper())]
    rules = c.TemplateRules(broadcast_bytes=0)
    want = brute(docs, items)
    assert {r[1] for r in want} == {1, 2, 3, 7, 8, 9}
    assert found(spark, docs, items, rules) == want


def test_short_items_alone(spark):
    docs = [(1, "we met Bob in May"), (2, "we met Ann in May"), (3, "nothing"), (4, None)]
    assert found(spark, docs, [(1, "met Bob"), (2, "nothing"), (3, "May")]) == brute(
        docs, [(1, "met Bob"), (2, "nothing"), (3, "May")]
    )
    assert found(spark, [], [(1, "met Bob")]) == found(spark, docs, []) == []
