"""Benchmark questions in documents, also with other numbers, names and units.

DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starweir.operators.lookups import fits_in_memory
from starweir.staging import stage

NUMBER, NAME, UNIT = "#0", "#n", "#u"
#: Before a word that is a name in one reading and itself in the other.
MAYBE = "#a"

#: Words that are units after a number.
UNITS = """mm cm m km in ft yd mi mg g kg lb lbs oz t ml cl dl l s sec min h hr hrs ms hz khz mhz
    w kw v a j kj kb mb gb tb usd eur dollar dollars cents euro euros pound pounds percent
    second seconds minute minutes hour hours day days week weeks month months year years
    meter meters metre metres kilometer kilometers mile miles foot feet inch inches gram
    grams kilogram kilograms liter liters litre litres degrees""".split()

# A capital after a lower-case word is no sentence's begin.
_NAME = r"(?<=[\p{Ll}\d][,;:]?[ \n])\p{Lu}[\p{L}\p{M}'’-]*"
# Other capitals that begin a word may be names, or plain words that begin a sentence, a
# line or a quotation. In a row of words in capitals only the first may be one.
_MAYBE = (
    r"(?=\p{Lu})(?<![\p{L}\p{M}\p{N}#][^\p{L}\p{M}\p{N}\s]{0,3})"
    r"(?:\p{Lu}['’-]?\p{Ll}|(?<!\p{Lu}[,;:]?[ \n])\p{Lu})[\p{L}\p{M}'’-]*"
)
_ATTACHED = r"(?<=\d)(?=\p{L})|(?<=\p{L})(?=\d)"
_ORDINAL = r"(?<=\d)(?:st|nd|rd|th)(?![\p{L}\p{N}])"
_NUMBER = r"(?<![\p{L}\p{N}#])\d+(?:[.,:/]\d+)*(?![\p{L}\p{N}])"
_UNIT = rf"(?<={NUMBER} )(?:{'|'.join(UNITS)})(?![\p{{L}}\p{{N}}])"
_BLANKS = "\t\n\x0b\x0c\r"
_PUNCTUATION = "!\"$%&'()*+,-./:;<=>?@[\\]^_`{|}~’‘“”«»¿¡…–—"


@dataclass(frozen=True)
class TemplateRules:
    #: Words in a window, and the share of an item's windows that must be found. An item
    #: of fewer words is one window.
    words: int = 5
    share: float = 0.8
    #: Share of an item's slot values that must have one counterpart in the document.
    consistent: float = 0.8
    #: Larger tables of words and windows are joined by a shuffle, not sent to every task.
    broadcast_bytes: int = 64 << 20


def _words(text: Column) -> Column:
    """Lower-case words without punctuation; what is punctuation only is no word."""
    plain = F.translate(text, _BLANKS + _PUNCTUATION, " " * len(_BLANKS))
    return F.array_remove(F.split(F.lower(plain), " "), "")


def _split(text: Column) -> Column:
    """The text without marks, with a blank between digits and letters that touch; the
    endings of ordinals go."""
    text = F.translate(text, "#", "")
    apart = F.regexp_replace(F.regexp_replace(text, _ORDINAL, ""), _ATTACHED, " ")
    return F.when(text.rlike(r"\d"), apart).otherwise(text)


def raw_words(text: Column) -> Column:
    return _words(_split(text))


def template_words(text: Column) -> Column:
    """The words with placeholders for numbers, names and units, at the same positions.

    A name is a word with a capital that does not begin a sentence, as far as the
    character before it tells; other words with a capital are marked with ``MAYBE``.
    """
    named = F.regexp_replace(F.regexp_replace(_split(text), _NAME, NAME), _MAYBE, MAYBE + "$0")
    typed = F.regexp_replace(F.regexp_replace(named, _NUMBER, NUMBER), _UNIT, UNIT)
    return _words(F.when(named.rlike(r"\d"), typed).otherwise(named))


def _plain(word: Column) -> Column:
    """A word in the reading in which what may be a name is none."""
    return F.when(word.startswith(MAYBE), F.substring(word, len(MAYBE) + 1, 1 << 30)).otherwise(word)


def _readings(window: Column) -> Column:
    """A hash for every reading of a window: each word that may be a name is one or not."""

    def longer(held: Column, word: Column) -> Column:
        with_word = F.transform(held, lambda w: F.concat(w, F.array(_plain(word))))
        with_name = F.transform(held, lambda w: F.concat(w, F.array(F.lit(NAME))))
        return F.when(word.startswith(MAYBE), F.concat(with_word, with_name)).otherwise(with_word)

    none = F.array(F.array().cast("array<string>"))
    every = F.transform(F.aggregate(window, none, longer), lambda w: F.xxhash64(w))
    open_ = F.exists(window, lambda w: w.startswith(MAYBE))
    return F.when(open_, every).otherwise(F.array(F.xxhash64(window)))


def _windows(words: Column, n: int) -> Column:
    """Every ``n`` consecutive words; none if there are fewer.

    ``words`` should be a column of its own: it is looked at for every window.
    """
    last = F.size(words) - n + 1
    windows = F.transform(F.sequence(F.lit(1), last), lambda i: F.slice(words, i, n))
    return F.when(last > 0, windows).otherwise(F.array().cast("array<array<string>>"))


def _texts(docs: DataFrame) -> DataFrame:
    """The texts and what identifies them: two hashes."""
    return docs.select(*_keys(), "text").where(F.col("text").isNotNull())


def _keys(text: str | Column = "text") -> list[Column]:
    return [F.xxhash64(text).alias("tie"), F.hash(text).alias("check")]


# What :func:`template_words` deletes, and at what it may cut a word.
_DELETED = "[#" + "".join(rf"\{c}" if c.isascii() else c for c in _PUNCTUATION) + "]+"
_CUT = r"[ \t\n\x0B\f\r0-9]+"


def _plain_words(text: Column) -> Column:
    """Words of the text, among them every word of :func:`template_words` that has neither
    digits nor placeholders; quick to tell."""
    return F.split(F.lower(F.regexp_replace(text, _DELETED, "")), _CUT)


def _items(benchmark: DataFrame) -> DataFrame:
    """One row per item with at least one word: its words, and how many."""
    return (
        benchmark.where("item_id IS NOT NULL AND text IS NOT NULL")
        .select(
            "item_id",
            F.xxhash64("text").alias("item_tie"),
            raw_words(F.col("text")).alias("item_raw"),
            template_words(F.col("text")).alias("item_words"),
        )
        .distinct()
        .withColumn("length", F.size("item_words"))
        .where("length > 0")
    )


def _item_windows(items: DataFrame, rules: TemplateRules) -> DataFrame:
    """One row for every reading of every window of the items."""
    return (
        items.select(
            "item_id",
            "item_tie",
            "windows",
            F.posexplode(_windows(F.col("item_words"), rules.words)).alias("item_at", "window"),
        )
        .withColumn("item_plain", F.xxhash64(F.transform("window", _plain)))
        .withColumn("hash", F.explode(_readings(F.col("window"))))
        .drop("window")
    )


def _needed(rules: TemplateRules) -> Column:
    """So many windows of an item that one at least is in a document with the needed share.
    Places are counted, not different windows: a share of the places is asked for."""
    return F.col("windows") - F.ceil(F.col("windows") * F.lit(rules.share)).cast("int") + 1


def _probes(windows: DataFrame, rules: TemplateRules) -> DataFrame:
    """The rarest windows of each item, in every reading, so many that one at least is in a
    document that has the needed share of them. Windows that many items have come last."""
    common = windows.groupBy("hash").agg(F.count(F.lit(1)).alias("items"))
    return (
        windows.join(common, "hash")
        .groupBy("item_id", "item_tie", "windows", "item_at")
        .agg(F.sum("items").alias("items"), F.collect_set("hash").alias("hashes"))
        .groupBy("item_id", "item_tie", "windows")
        .agg(F.sort_array(F.collect_list(F.struct("items", "hashes", "item_at"))).alias("ranked"))
        .select("item_id", "item_tie", F.inline(F.slice("ranked", F.lit(1), _needed(rules))))
        .select("item_id", "item_tie", F.explode("hashes").alias("hash"))
        .distinct()
    )


def _rarest_words(texts: DataFrame, items: DataFrame, rules: TemplateRules) -> DataFrame:
    """(item_id, item_tie, windows, item_at, best): of each window of the items the word that
    is rarest in the corpus, with how often it is there. A window without a word that every
    reading keeps has NULL."""
    window_words = items.select(
        "item_id",
        "item_tie",
        "windows",
        F.posexplode(_windows(F.col("item_words"), rules.words)).alias("item_at", "window"),
    ).withColumn("kept", F.filter("window", lambda w: ~w.rlike(r"[#\d]")))
    kept = stage(window_words.drop("window"), "window-words")
    words = kept.select(F.explode("kept").alias("word")).distinct()
    seen = (
        texts.select(F.explode(_plain_words(F.col("text"))).alias("word"))
        .join(_small(words, rules), "word")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # A word that no document has is the best there is: its window matches nothing.
    return (
        kept.select("item_id", "item_tie", "windows", "item_at", F.explode_outer("kept").alias("word"))
        .join(seen, "word", "left")
        .groupBy("item_id", "item_tie", "windows", "item_at")
        .agg(
            F.min(
                F.struct(
                    F.when(F.col("word").isNull(), 1 << 62).otherwise(F.coalesce("n", F.lit(0))).alias("n"),
                    "word",
                )
            ).alias("best")
        )
    )


def _word_probes(rarest: DataFrame, rules: TemplateRules) -> DataFrame:
    """(item_id, item_tie, word): the rarest words of so many windows of each item that a
    document that holds the item has one of them. ``word`` is NULL for an item of which such
    a window has no word."""
    return (
        rarest.groupBy("item_id", "item_tie", "windows")
        .agg(F.sort_array(F.collect_list(F.struct("best.n", "best.word"))).alias("ranked"))
        .select("item_id", "item_tie", F.inline(F.slice("ranked", F.lit(1), _needed(rules))))
        .select("item_id", "item_tie", "word")
        .distinct()
    )


def _small(df: DataFrame, rules: TemplateRules) -> DataFrame:
    """``df``, sent to every task if it is measured to be small."""
    return F.broadcast(df) if fits_in_memory(df, rules.broadcast_bytes) else df


def _candidates(docs: DataFrame, items: DataFrame, windows: DataFrame, rules: TemplateRules) -> DataFrame:
    """(tie, check, item_id, item_tie): texts that may hold an item."""
    texts = _texts(docs)
    rarest = stage(_rarest_words(texts, items, rules), "rarest-words")
    probes = stage(_word_probes(rarest, rules), "word-probes")
    by_word = (
        texts.select("tie", "check", F.explode(_plain_words(F.col("text"))).alias("word"))
        .join(_small(probes.where("word IS NOT NULL"), rules), "word")
        .select(*_PAIR)
    )
    by_word = _with_most_words(texts, stage(by_word.distinct(), "with-a-word"), rarest, rules)
    wordless = probes.where("word IS NULL").select("item_id", "item_tie").distinct()
    if not wordless.isEmpty():
        rest = _probes(windows.join(wordless, ["item_id", "item_tie"], "left_semi"), rules)
        by_window = (
            texts.select("tie", "check", template_words(F.col("text")).alias("words"))
            .withColumn("windows", _windows(F.col("words"), rules.words))
            # The outer form lets Spark infer no filter on the hashes, which would be pushed
            # below them and make the words anew for every window.
            .select(
                "tie", "check", F.explode_outer(F.flatten(F.transform("windows", _readings))).alias("hash")
            )
            .join(_small(stage(rest, "probes"), rules), "hash")
            .select(*_PAIR)
        )
        by_word = by_word.unionByName(by_window)
    return stage(by_word.distinct(), "candidates")


def _with_most_words(
    texts: DataFrame, pairs: DataFrame, rarest: DataFrame, rules: TemplateRules
) -> DataFrame:
    """Those of ``pairs`` whose text has the rarest words of the needed share of the item's
    windows; without them it cannot have the windows."""
    held = _small(stage(pairs.select("tie", "check").distinct(), "with-words"), rules)
    words = (
        texts.join(held, ["tie", "check"], "left_semi")
        .dropDuplicates(["tie", "check"])
        .select("tie", "check", F.explode(F.array_distinct(_plain_words(F.col("text")))).alias("word"))
        .join(_small(rarest.select("best.word").distinct(), rules), "word", "left_semi")
    )
    windows = rarest.select("item_id", "item_tie", "windows", "best.word").groupBy(
        "item_id", "item_tie", "windows", "word"
    ).agg(F.count(F.lit(1)).alias("n"))
    asked = pairs.join(windows, ["item_id", "item_tie"])
    # A window without such a word may be in any text.
    free = asked.where("word IS NULL").select(*_PAIR, "windows", "n")
    there = asked.join(words, ["tie", "check", "word"]).select(*_PAIR, "windows", "n")
    return (
        there.unionByName(free)
        .groupBy(*_PAIR, "windows")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= F.ceil(F.col("windows") * F.lit(rules.share)))
        .select(*_PAIR)
    )


def find_contaminated(
    docs: DataFrame, benchmark: DataFrame, rules: TemplateRules = TemplateRules()
) -> DataFrame:
    """(doc_id, tie, item_id, windows, found, slots, consistent, changed): the documents
    that hold an item of ``benchmark``, one row for each item they hold.

    Words become templates: numbers, names and units give way to placeholders of their
    type. A capital that begins a sentence may be a name or not, so windows match in either
    reading. A document is a candidate if a rare word of the item is in it, or a rare
    template window where an item has no such words. Then all windows of both are matched,
    and item and document are laid side by side at every distance at which windows match.
    ``found`` of the item's ``windows`` must be a share of at least ``share``. The values
    that stand for the placeholders must go with each other: of the item's ``slots``
    distinct values, ``consistent`` have one counterpart that has no other. ``changed``
    counts values that differ: 0 for a verbatim copy.

    An item with fewer words than a window is one window of its own length, and found only
    with its own values: with others, a few words say nothing.

    NULL texts, and items without words or with a NULL id, match nothing. A NULL doc_id is
    kept as such. Equal rows count once; texts of one doc_id are told apart by ``tie``.
    Empty tables give no rows. Equal texts are looked at once.
    """
    items = stage(_items(benchmark), "items")
    words = F.least("length", F.lit(rules.words))
    # As many numbers as a window has words, at most.
    sizes = [n for (n,) in items.select(words).distinct().collect()] or [rules.words]

    def found(n: int) -> DataFrame:
        some = _found(docs, items.where(words == n), replace(rules, words=n))
        return some if n == rules.words else some.where("changed = 0")

    return reduce(DataFrame.unionByName, map(found, sorted(sizes)))


def _found(docs: DataFrame, items: DataFrame, rules: TemplateRules) -> DataFrame:
    """:func:`find_contaminated` for items that have at least one window."""
    items = items.withColumn("windows", F.col("length") - rules.words + 1).drop("length")
    windows = stage(_item_windows(items, rules), "item-windows")
    candidates = _candidates(docs, items, windows, rules)
    held = _small(stage(candidates.select("tie", "check").distinct(), "held"), rules)
    text = F.col("text")
    placed = (
        _texts(docs)
        .join(held, ["tie", "check"], "left_semi")
        .dropDuplicates(["tie", "check"])
        .select("tie", "check", raw_words(text).alias("raw"), template_words(text).alias("words"))
        .withColumn("windows", _windows(F.col("words"), rules.words))
        .withColumn("values", _windows(F.col("raw"), rules.words))
        .select("tie", "check", F.posexplode(F.arrays_zip("windows", "values")).alias("at", "both"))
        .select(
            "tie",
            "check",
            "at",
            F.col("both.values").alias("values"),
            F.xxhash64(F.transform("both.windows", _plain)).alias("plain"),
            F.explode_outer(_readings(F.col("both.windows"))).alias("hash"),
        )
    )
    # Most windows of a candidate are no item's; they need not be shuffled.
    placed = placed.join(_small(windows.select("hash").distinct(), rules), "hash", "left_semi")
    # A candidate's windows are as many as the item has; no window meets another's item.
    wanted = candidates.join(windows, ["item_id", "item_tie"])
    judged = _judged(placed.join(wanted, ["tie", "check", "hash"]), items, rules)
    judged = stage(judged, "judged")
    rows = docs.where("text IS NOT NULL").select("doc_id", *_keys()).distinct()
    return rows.join(_small(judged, rules), ["tie", "check"]).select(
        "doc_id", "tie", *[c for c in judged.columns if c not in ("tie", "check", "item_tie")]
    )


_PAIR = ["tie", "check", "item_id", "item_tie"]


def _copies(found: DataFrame) -> DataFrame:
    """For each pair of document and item, and each reading, the places that may be one
    copy of the item: the distances at which to lay it, nearest to the copy's own first, with
    the windows matched there."""
    by_shift = (
        found.withColumn("shift", F.col("at") - F.col("item_at"))
        .groupBy(*_PAIR, "windows", "shift")
        .agg(
            F.collect_set(F.struct("item_at", "values")).alias("named"),
            F.collect_set(
                F.when(F.col("plain") == F.col("item_plain"), F.struct("item_at", "values"))
            ).alias("strict"),
        )
    )
    shifts = stage(
        by_shift.select(
            *_PAIR,
            "windows",
            "shift",
            F.inline(
                F.array(
                    F.struct(F.lit(True).alias("plain"), F.col("strict").alias("matched")),
                    F.struct(F.lit(False).alias("plain"), F.col("named").alias("matched")),
                )
            ),
        ).where(F.size("matched") > 0),
        "shifts",
    )
    # A window by chance is no copy, but what is next to a copy is part of it.
    strong = (F.size("matched") >= 3) | (F.size("matched") * 2 >= F.col("windows"))
    whole = [*_PAIR, "plain", "windows"]
    place = F.struct("shift", "matched")
    # Half an item's length: never two copies that follow one another.
    order = F.floor(F.col("shift") * 1000 / F.col("windows"))
    near = Window.partitionBy(*whole).orderBy(order).rangeBetween(-500, 500)
    alone = shifts.where(strong).select(*whole, "shift", F.array(place).alias("places"))
    close = (
        shifts.withColumn("places", F.collect_list(place).over(near))
        .where(strong)
        .select(*whole, "shift", "places")
    )
    # However long what is put in between.
    most = F.max_by("shift", F.struct(F.size("matched"), -F.col("shift"))).alias("shift")
    pooled = shifts.where(strong).groupBy(*whole).agg(most, F.collect_list(place).alias("places"))
    several = F.size("places") > 1
    distance = lambda p: F.struct(F.abs(p["shift"] - F.col("shift")).alias("off"), p["shift"], p["matched"])
    return (
        alone.unionAll(close.where(several))
        .unionAll(pooled.where(several).select(alone.columns))
        .withColumn("places", F.sort_array(F.transform("places", distance)))
    )


def _judged(found: DataFrame, items: DataFrame, rules: TemplateRules) -> DataFrame:
    n = F.lit(rules.words)

    def value(p: Column) -> Column:
        """The document's word for the item's word ``p``, at the nearest place that has it."""
        covering = F.flatten(
            F.transform(
                "places",
                lambda place: F.filter(
                    place["matched"], lambda m: (m["item_at"] <= p) & (p < m["item_at"] + n)
                ),
            )
        )
        first = F.get(covering, F.lit(0))
        return F.get(first["values"], p - first["item_at"])

    def is_slot(p: Column) -> Column:
        word = F.get("item_words", p)
        return word.isin(NUMBER, NAME, UNIT) | (~F.col("plain") & word.startswith(MAYBE))

    positions = F.sequence(F.lit(0), F.size("item_words") - 1)
    values = F.transform(
        F.filter(positions, is_slot),
        lambda p: F.struct(
            F.get("item_raw", p).alias("item"),
            value(p).alias("doc"),
            F.get("item_words", p).startswith(MAYBE).alias("maybe"),
        ),
    )
    pairs = (
        _copies(found)
        .withColumn(
            "found",
            F.size(
                F.array_distinct(
                    F.flatten(F.transform("places", lambda x: x["matched"]["item_at"]))
                )
            ),
        )
        .where(F.col("found") >= F.ceil(F.col("windows") * F.lit(rules.share)))
        .join(items.drop("windows"), ["item_id", "item_tie"])
        .withColumn("values", F.filter(values, lambda v: v["doc"].isNotNull()))
    )
    # A sentence's first word that stays as it is need not be a name.
    named = F.filter("values", lambda v: ~v["maybe"] | (v["item"] != v["doc"]))
    keys = F.array_distinct(F.transform(named, lambda v: v["item"]))
    distinct = F.array_distinct(
        F.transform("values", lambda v: F.struct(v["item"].alias("item"), v["doc"].alias("doc")))
    )

    def alone(key: Column) -> Column:
        own = F.filter("values", lambda v: v["item"] == key)
        back = F.filter("values", lambda v: v["doc"] == own[0]["doc"])
        return (F.size(own) == 1) & (F.size(back) == 1)

    best = F.struct("found", (-F.col("changed")).alias("same"), "slots", "consistent", "windows")
    return (
        pairs.withColumn("keys", keys)
        .withColumn("values", distinct)
        .withColumn("slots", F.size("keys"))
        .withColumn("consistent", F.size(F.filter("keys", alone)))
        .withColumn("changed", F.size(F.filter("values", lambda v: v["item"] != v["doc"])))
        .where(F.col("consistent") >= F.ceil(F.col("slots") * F.lit(rules.consistent)))
        .groupBy(*_PAIR)
        .agg(F.max(best).alias("best"))
        .select(
            *_PAIR,
            "best.windows",
            "best.found",
            "best.slots",
            "best.consistent",
            (-F.col("best.same")).alias("changed"),
        )
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, rules: TemplateRules = TemplateRules()
) -> DataFrame:
    """``docs`` without the documents that hold an item; NULL texts stay."""
    bad = find_contaminated(docs, benchmark, rules).select("doc_id", "tie").distinct()
    bad = stage(bad, "contaminated")
    same = F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")) & (
        F.xxhash64(F.col("d.text")) == F.col("b.tie")
    )
    return docs.alias("d").join(bad.alias("b"), same, "left_anti")
