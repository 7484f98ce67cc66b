r"""Benchmark decontamination by template canonicalisation.

Texts become templates: words in lower case without punctuation around them, with typed placeholders for

* numbers  words that begin with a digit,
* units    a word of ``UNITS`` behind or glued to a number,
* names    words that begin with a capital and do not begin a sentence.

A second, blind template does not ask for sentences or the case of units. Its windows have two keys, one with all
capitalised words as names and one with none as names; a window matches if either key does. So a copy in capitals, in
title case or without punctuation is found, and one whose names begin sentences. It counts where the first template
finds nothing for a document and item.

Of each template, windows of eight tokens of all documents are hash-joined with those of the benchmark. Matches of one
document and item that lie on one diagonal (position minus position) side by side are a run. Runs that rise in both
texts form a chain; between two of them the document may hold as many other words as the item has windows (32 at
least), the item any number. So an inserted, dropped or replaced word parts a match in two runs of one chain. A document
is contaminated where a chain covers at least half of the item's windows, or half of the words in them, or has a run of
``RUN`` windows, and its slots are consistent: along the chain, every value of an item's slot always stands for one and
the same value of the document. So a question with other numbers or names is caught, and text that merely has the same
shape is not.

Of every window of the benchmark that counts, three words side by side that are no slots are its sign (two or one, where slots
leave no more): a text that holds the window holds its sign. While the benchmark is small, only texts that hold some sign
are made templates; which these are is found on their plain words, much cheaper, and changes no result.

Everything is DataFrame functions. The benchmark's windows are broadcast if they are counted to be few, else both
sides are shuffled by the window's hash.

Defined results
* NULL and empty texts, and items of fewer tokens than a window, match nothing; windows of which more than half are
  placeholders do not count.
* A NULL id (of a document or an item) takes no part.
* Rows that repeat an id with equal text count once; with different texts, the best chain counts.
* Among consistent chains of one document and item the one with most windows counts, then the first. To choose from
  are each diagonal alone and, for each run, the chain that ends there and covers most.
* Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feira.llm.common import stored, version
from feira.plans.sizing import checked_broadcast

WINDOW = 8
COVERED = 0.5
# 50 words in a row, however long the item is
RUN = 43
# words between two runs that a short item allows
LEAST_GAP = 32
# fixed values: units that may follow a number
UNITS = [
    "%", "mm", "cm", "m", "km", "in", "ft", "mi", "inch", "inches", "foot", "feet", "yard", "yards", "mile", "miles",
    "meter", "meters", "metre", "metres", "kilometer", "kilometers", "kilometre", "kilometres",
    "mg", "g", "kg", "t", "lb", "lbs", "oz", "gram", "grams", "kilogram", "kilograms", "pound", "pounds", "ounce", "ounces",
    "ml", "l", "liter", "liters", "litre", "litres", "gallon", "gallons", "cup", "cups",
    "ms", "s", "h", "sec", "second", "seconds", "min", "minute", "minutes", "hour", "hours",
    "day", "days", "week", "weeks", "month", "months", "year", "years",
    "km/h", "mph", "usd", "eur", "gbp", "dollar", "dollars", "cent", "cents", "euro", "euros",
    "percent", "degree", "degrees", "celsius", "fahrenheit",
]
NUMBER, NAME, UNIT = "\x01", "\x02", "\x03"
_BEHIND_MARKS = "\x04"
BROADCAST_ROWS = 300_000
# windows of the benchmark up to which texts are looked through for their signs, which are literals of the plan
SIGNED_WINDOWS = 50_000

SENTENCES, BLIND = 0, 1
#: (pattern, replacement) in order; neither Java nor RE2 needs look-around for them
_UNIT_PATTERN = "(\x01[0-9.,]*[0-9]) ?(" + "|".join(sorted(UNITS, key=lambda u: (-len(u), u))) + ")([^\\p{L}\\p{N}]|$)"
STEPS = [
    ("[\\x01-\\x03\\x09-\\x0D\\x20]+", " "),
    (" [^\\p{L}\\p{N} ]*(\\p{Lu})", " \x02$1"),
    ("([.!?:]|^) \x02", "$1 "),
    (" [^\\p{L}\\p{N}\x02 ]*([0-9])", " \x01$1"),
    (_UNIT_PATTERN, "$1 \x03$2$3"),
    ("[.,'%/]+( |$)| [.,'%/]+", " "),
    (" +", " "),
]
# marks that part words wherever they stand; they become blanks before the last two steps
PARTING = "!\"#$&()*+:;<=>?@[]^_`{|}~\\¡¿«»–—‘’“”„…·•"
SLOT = "([\\x01-\\x03])[^ ]*"
_BLIND_UNIT_PATTERN = _UNIT_PATTERN.replace(" ?(", " ?\x02?(", 1)


# The same steps as Java runs them fastest: a single space stays as it is, a word that begins with a small letter is left at
# once, groups do not hold the first character, and the marks become blanks in the pass that strips the others from words.
_MARKS = "".join("\\" + c if c in "[]\\^&" else c for c in PARTING)
_QUICK_SPACES = ("[\\x01-\\x03\\x09-\\x0D][\\x01-\\x03\\x09-\\x0D\\x20]*| [\\x01-\\x03\\x09-\\x0D\\x20]+", " ")
_QUICK_NAMES = (" (?![a-z])[^\\p{L}\\p{N} ]*(\\p{Lu})", STEPS[1][1])
_QUICK_SENTENCES = ("\x02(?<=[.!?:] \x02|^ \x02)", "")
_QUICK_NUMBERS = (" (?![a-z\x02])[^\\p{L}\\p{N}\x02 ]*([0-9])", STEPS[3][1])
_QUICK_PARTED = (f"(?![0-9a-z])(?:[.,'%/]+([ {_MARKS}]|$)|[ {_MARKS}][.,'%/]+|[{_MARKS}])", " ")


def _quick_unit(pattern: str) -> tuple[str, str]:
    return pattern.replace("(\x01", "\x01(", 1), "\x01" + STEPS[4][1]


def _replaced(out: Column, steps: list[tuple[str, str]]) -> Column:
    for pattern, replacement in steps:
        out = F.regexp_replace(out, pattern, replacement)
    return out


def _parted(out: Column) -> Column:
    """The last steps, but for the single spaces: ``tokens_of`` leaves empty tokens out instead."""
    return _replaced(out, [_QUICK_PARTED])


def marked(text: Column) -> Column:
    """What both templates begin with: single spaces, and capitalised words and numbers with a mark.

    Numbers are marked before sentences are looked at; neither step touches what the other finds.
    """
    return _replaced(F.concat(F.lit(" "), F.coalesce(text, F.lit(""))), [_QUICK_SPACES, _QUICK_NAMES, _QUICK_NUMBERS])


def valued(start: Column) -> Column:
    """Template tokens of ``marked`` text between spaces; slots are a type mark and the value."""
    return F.lower(_parted(_replaced(start, [_QUICK_SENTENCES, _quick_unit(_UNIT_PATTERN)])))


def blind_valued(start: Column) -> Column:
    """The same for the blind template, with all capitalised words as names."""
    return _parted(_replaced(F.lower(start), [_quick_unit(_BLIND_UNIT_PATTERN)]))


def tokens_of(values: Column) -> Column:
    return F.array_remove(F.split(values, " "), "")


def _is_slot(token: Column) -> Column:
    return (token >= NUMBER) & (token < _BEHIND_MARKS)


def _bare(token: Column) -> Column:
    """Slots as their type mark alone."""
    return F.when(_is_slot(token), F.substring(token, 1, 1)).otherwise(token)


def templates(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` once per way of writing their ``text``: ``kind`` of template, ``way``, and ``tokens`` instead of the text."""
    others = [c for c in rows.columns if c != text]
    starts = rows.select(*others, marked(F.col(text)).alias("start"))
    values = starts.select(*others, valued(F.col("start")).alias("a"), blind_valued(F.col("start")).alias("b"))
    ways = [(SENTENCES, F.col("a")), (BLIND, F.col("b")), (BLIND, F.replace("b", F.lit(NAME)))]
    structs = [
        F.struct(F.lit(kind).alias("kind"), F.lit(way).alias("way"), tokens_of(v).alias("tokens"))
        for way, (kind, v) in enumerate(ways)
    ]
    return values.select(*others, F.explode_outer(F.array(*structs)).alias("t")).select(*others, "t.*")


def with_window_keys(rows: DataFrame) -> DataFrame:
    """``rows`` with ``keys``: a 64-bit key per window of eight of their ``tokens``, other ones for each ``way``.

    Keys of one, two and four tokens are paired with those that begin where they end. Explode the keys with the
    outer form: of the inner one the optimizer infers a filter that computes them again.
    """
    rows = rows.withColumn("keys", F.transform("tokens", lambda t: F.xxhash64(_bare(t))))
    size = 1
    while size < WINDOW:
        behind = F.slice("keys", size + 1, F.size("keys"))
        salt = [F.col("way")] if 2 * size == WINDOW else []
        rows = rows.withColumn("keys", F.zip_with("keys", behind, lambda a, b: F.xxhash64(*salt, a, b)))
        size *= 2
    # the last seven were paired with nothing
    whole = F.size("keys") - (WINDOW - 1)
    return rows.withColumn("keys", F.when(whole > 0, F.slice("keys", 1, F.greatest(whole, F.lit(0)))))


def _mostly_slots(tokens: Column) -> Column:
    return F.size(F.filter(tokens, _is_slot)) * 2 > F.size(tokens)


def item_windows(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, kind, at, key, n_windows, n_words): the benchmark's windows that count, and how many words lie in them."""
    rows = items.select(F.col(item_id).alias("item"), F.col(text).alias("text")).filter("item is not null")
    rows = with_window_keys(templates(rows, "text").filter(F.size("tokens") >= WINDOW))
    windows = rows.select("item", "kind", "tokens", F.posexplode_outer("keys").alias("at", "key")).filter("key is not null")
    windows = windows.filter(~_mostly_slots(F.slice("tokens", F.col("at") + 1, WINDOW))).select("item", "kind", "at", "key").distinct()
    counts = windows.groupBy("item", "kind").agg(F.collect_set("at").alias("ats"))
    inside = F.array_distinct(F.flatten(F.transform("ats", lambda at: F.sequence(at, at + (WINDOW - 1)))))
    counts = counts.select("item", "kind", F.size("ats").alias("n_windows"), F.size(inside).alias("n_words"))
    return windows.join(counts, ["item", "kind"])


def _words(text: Column) -> Column:
    """Letters and digits side by side, in lower case. No step of the templates takes any away or parts a word that is no slot;
    only the small sigma's form may depend on what stands around it."""
    return F.split(F.replace(F.lower(text), F.lit("ς"), F.lit("σ")), "(?![0-9a-z])[^\\p{L}\\p{N}]+")


def window_signs(items: DataFrame, text: str) -> DataFrame:
    """(sign, n_words): of each window that counts the longest three words side by side without a slot, or two, or one."""
    rows = templates(items.select(F.col(text).alias("text")), "text").filter(F.size("tokens") >= WINDOW)
    places = F.sequence(F.lit(1), F.size("tokens") - (WINDOW - 1))
    windows = rows.select(F.explode(F.transform(places, lambda at: F.slice("tokens", at, WINDOW))).alias("w")).distinct()
    windows = windows.filter(~_mostly_slots(F.col("w")))
    plain = F.array_join(F.transform("w", lambda t: F.when(_is_slot(t), NUMBER).otherwise(t)), " ")

    def parts(words: Column) -> Column:
        begins = F.sequence(F.lit(1), F.size(words))
        some = F.flatten(F.transform(begins, lambda at: F.array(*[F.slice(words, at, n) for n in (1, 2, 3)])))
        return F.when(F.size(words) > 0, some).otherwise(F.array().cast("array<array<string>>"))

    runs = F.transform(F.split(plain, NUMBER), lambda run: F.array_remove(_words(run), ""))
    best = F.array_max(
        F.transform(
            F.flatten(F.transform(runs, parts)),
            lambda p: F.struct(F.size(p).alias("n"), F.length(F.array_join(p, "")).alias("long"), p.alias("words")),
        )
    )
    return windows.select(best["words"].alias("sign"), best["n"].alias("n_words")).distinct()


def _key_sql(*words: str) -> str:
    """Without the sign bit, so that every key can be written as a literal."""
    return f"shiftrightunsigned(xxhash64({', '.join(words)}), 1)"


def holding_signs(rows: DataFrame, text: str, signs: DataFrame) -> DataFrame:
    """``rows`` whose text may hold a window of the ``signs``: none that does is left out. All rows, if a window has no sign."""
    at = [f"sign[{k}]" for k in range(3)]
    keys = signs.select("n_words", *[F.expr(f"CASE WHEN n_words >= {k} THEN {_key_sql(*at[:k])} END").alias(f"k{k}") for k in (1, 2, 3)])
    known = keys.distinct().collect()
    if any(r.n_words is None for r in known):
        return rows
    whole = {n: {r[f"k{n}"] for r in known if r.n_words == n} for n in (1, 2, 3)}
    first_two = whole[2] | {r.k2 for r in known if r.n_words == 3}

    def among(key: str, values: set[int]) -> str:
        return f"{key} IN ({', '.join(f'{v}L' for v in sorted(values))})" if values else "false"

    following = ["x", "get(w, i + 1)", "get(w, i + 2)"]
    one, two, three = [_key_sql(*following[:k]) for k in (1, 2, 3)]
    held = (
        f"({among(two, first_two)} AND ({among(three, whole[3])} OR {among(two, whole[2])})) OR {among(one, whole[1])}"
    )
    # the words are bound to w, so that they are parted once
    found = F.expr(f"exists(array(__words), w -> exists(transform(w, (x, i) -> {held}), y -> y))")
    return rows.withColumn("__words", _words(F.col(text))).filter(found).drop("__words")


def matched_runs(
    docs: DataFrame, items: DataFrame, doc_id: str, text: str, item_id: str, item_text: str
) -> DataFrame:
    """(doc, ver, item, kind, n_windows, n_words, shift, first, last): matched windows side by side on one diagonal."""
    wanted = stored(item_windows(items, item_id, item_text), "item-windows")
    rows = docs.select(F.col(doc_id).alias("doc"), version(F.col(text)).alias("ver"), F.col(text).alias("text"))
    rows = rows.filter("doc is not null")
    if wanted.limit(SIGNED_WINDOWS + 1).count() <= SIGNED_WINDOWS:
        rows = holding_signs(rows, "text", window_signs(items.filter(F.col(item_id).isNotNull()), item_text))
    rows = templates(rows, "text")
    wanted = checked_broadcast(wanted, BROADCAST_ROWS)
    windows = with_window_keys(rows).select("doc", "ver", F.posexplode_outer("keys").alias("pos", "key")).filter("key is not null")
    met = windows.join(wanted, "key").select(
        "doc", "ver", "item", "kind", "n_windows", "n_words", "at", (F.col("pos") - F.col("at")).alias("shift")
    )
    nth = F.dense_rank().over(Window.partitionBy("doc", "ver", "item", "kind").orderBy("shift", "at"))
    return (
        met.withColumn("run", F.col("at") - nth)
        .groupBy("doc", "ver", "item", "kind", "n_windows", "n_words", "shift", "run")
        .agg(F.min("at").alias("first"), F.max("at").alias("last"))
        .drop("run")
    )


_CHAIN = "struct<words:int,n:int,few:int,last:int,end:int,parts:array<struct<shift:int,first:int,last:int>>>"


def _enough(n: Column, words: Column, longest: Column) -> Column:
    """Whether so many windows and words of an item, with a run of so many windows, are a leak."""
    return (n >= F.col("n_windows") * COVERED) | (words >= F.col("n_words") * COVERED) | (longest >= RUN)


def _chain(words: Column, n: Column, run: Column, parts: Column) -> Column:
    return F.struct(
        words.alias("words"), n.alias("n"), (-F.size(parts)).alias("few"),
        run["last"].alias("last"), (run["last"] + run["shift"]).alias("end"), parts.alias("parts"),
    )


def _part(shift: Column, first: Column, last: Column) -> Column:
    return F.struct(shift.alias("shift"), first.alias("first"), last.alias("last"))


def _longer(chain: Column, run: Column) -> Column:
    """``chain`` with the windows of ``run`` behind its own; on the same diagonal its last part grows."""
    start = F.greatest(run["first"], chain["last"] + 1, chain["end"] + 1 - run["shift"])
    tail = F.element_at(chain["parts"], -1)
    same = tail["shift"] == run["shift"]
    kept = F.when(same, F.slice(chain["parts"], 1, F.size(chain["parts"]) - 1)).otherwise(chain["parts"])
    # a part begins behind the words of the one before
    first = F.when(same, tail["first"]).otherwise(F.greatest(start, F.least(chain["last"] + WINDOW, run["last"])))
    parts = F.concat(kept, F.array(_part(run["shift"], first, run["last"])))
    words = F.least(run["last"] - start + WINDOW, run["last"] - chain["last"])
    return _chain(chain["words"] + words, chain["n"] + run["last"] - start + 1, run, parts)


def _chains(runs: Column) -> Column:
    """For each of ``runs`` (sorted by their place in the document) the best chain that ends there, if it is enough.

    ``open`` are the chains near enough to go on.
    """
    gap = F.greatest(F.col("n_windows"), F.lit(LEAST_GAP)) + WINDOW

    def step(state: Column, run: Column) -> Column:
        near = F.filter(state["open"], lambda c: run["pos"] - c["end"] <= gap)
        fits = F.filter(near, lambda c: (run["last"] > c["last"]) & (run["last"] + run["shift"] > c["end"]))
        n = run["last"] - run["first"] + 1
        alone = _chain(n + (WINDOW - 1), n, run, F.array(_part(run["shift"], run["first"], run["last"])))
        best = F.array(F.array_max(F.concat(F.transform(fits, lambda c: _longer(c, run)), F.array(alone))))
        done = F.filter(best, lambda c: _enough(c["n"], c["words"], n))
        return F.struct(F.concat(near, best).alias("open"), F.concat(state["done"], done).alias("done"))

    none = F.array().cast(f"array<{_CHAIN}>")
    return F.aggregate(runs, F.struct(none.alias("open"), none.alias("done")), step, lambda state: state["done"])


def alignments(
    docs: DataFrame, items: DataFrame, doc_id: str, text: str, item_id: str, item_text: str
) -> DataFrame:
    """(doc, ver, item, kind, n_windows, n_matched, parts): diagonals and chains that cover enough, slots not yet checked."""
    runs = stored(matched_runs(docs, items, doc_id, text, item_id, item_text), "matched-runs")
    n = F.col("last") - F.col("first") + 1
    pair = ["doc", "ver", "item", "kind", "n_windows", "n_words"]
    diagonals = (
        runs.groupBy(*pair, "shift")
        .agg(F.sum(n).cast("int").alias("n_matched"), F.min("first").alias("first"), F.max("last").alias("last"))
        .filter(F.col("n_matched") >= F.col("n_windows") * COVERED)
        .select("doc", "ver", "item", "kind", "n_windows", "n_matched", F.array(_part(F.col("shift"), F.col("first"), F.col("last"))).alias("parts"))
    )
    run = F.struct((F.col("first") + F.col("shift")).alias("pos"), "first", "last", "shift")
    chains = (
        runs.groupBy(*pair)
        .agg(F.sum(n).alias("n"), F.sum(n + (WINDOW - 1)).alias("words"), F.max(n).alias("longest"), F.collect_list(run).alias("runs"))
        .filter(_enough(F.col("n"), F.col("words"), F.col("longest")))
        .withColumn("chain", F.explode(_chains(F.sort_array("runs"))))
        .select("doc", "ver", "item", "kind", "n_windows", F.col("chain.n").alias("n_matched"), "chain.parts")
    )
    return diagonals.unionByName(chains)


def _values_by_kind(text: Column, side: str) -> list[Column]:
    return [valued(marked(text)).alias(f"{side}_a"), blind_valued(marked(text)).alias(f"{side}_b")]


def contaminated(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per document and benchmark item that it holds: ids, ``n_matched`` of ``n_windows`` windows, ``n_slots``
    compared, and whether a slot's value was ``reparameterised``."""
    found = stored(alignments(docs, items, doc_id, text, item_id, item_text), "alignments")
    asked = checked_broadcast(found.select("doc", "ver").distinct(), BROADCAST_ROWS)
    doc_tokens = (
        docs.select(F.col(doc_id).alias("doc"), version(F.col(text)).alias("ver"), F.col(text).alias("t"))
        .join(asked, ["doc", "ver"])
        .dropDuplicates(["doc", "ver"])
        .select("doc", "ver", *_values_by_kind(F.col("t"), "theirs"))
    )
    item_tokens = items.select(F.col(item_id).alias("item"), *_values_by_kind(F.col(item_text), "own"))
    both = found.join(item_tokens, "item").join(doc_tokens, ["doc", "ver"])
    for side in ("own", "theirs"):
        both = both.withColumn(side, tokens_of(F.when(F.col("kind") == BLIND, F.col(f"{side}_b")).otherwise(F.col(f"{side}_a"))))
    marks = [NUMBER, NAME, UNIT]

    def slots_of(part: Column) -> Column:
        span = part["last"] - part["first"] + WINDOW
        own = F.slice("own", part["first"] + 1, span)
        theirs = F.slice("theirs", part["first"] + part["shift"] + 1, span)
        pairs = F.zip_with(own, theirs, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        # slots of one type at one place; elsewhere the part has a gap or the same word
        return F.filter(pairs, lambda z: F.substring(z["a"], 1, 1).isin(marks) & (F.substring(z["a"], 1, 1) == F.substring(z["b"], 1, 1)))

    slots = F.flatten(F.transform("parts", slots_of))
    checked = both.withColumn("slots", slots).withColumn(
        "consistent",
        F.size(F.array_distinct("slots")) == F.size(F.array_distinct(F.transform("slots", lambda z: z["a"]))),
    )
    best = Window.partitionBy("doc", "item").orderBy("kind", F.desc("n_matched"), F.col("parts")[0]["shift"], "ver", "parts")
    return (
        checked.filter("consistent")
        .withColumn("nth", F.row_number().over(best))
        .filter("nth = 1")
        .select(
            F.col("doc").alias(doc_id),
            F.col("item").alias(item_id),
            F.col("n_matched").cast("bigint").alias("n_matched"),
            F.col("n_windows").cast("bigint").alias("n_windows"),
            F.size("slots").cast("bigint").alias("n_slots"),
            F.exists("slots", lambda z: z["a"] != z["b"]).alias("reparameterised"),
        )
    )


def without_contaminated(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    bad = contaminated(docs, items, doc_id, text, item_id, item_text).select(F.col(doc_id).alias("__bad")).distinct()
    return docs.join(bad, F.col(doc_id) == F.col("__bad"), "left_anti")
