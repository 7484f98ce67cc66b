"""The decontamination query and operator against their definition written out in plain Python."""

import random
from collections import defaultdict

import pytest
import regex
from pyspark.sql import functions as F

from feira.llm import decontaminate as d
from feira.llm.queries import QUERIES


def replaced(text, steps):
    for pattern, back in steps:
        text = regex.sub(pattern, back.replace("$", "\\"), text)
    return text


def parted(text):
    return replaced(text.translate(str.maketrans(d.PARTING, " " * len(d.PARTING))), d.STEPS[5:])


def ways(text):
    """(kind, tokens with their values) of the three ways of writing a text; all steps in the order of ``STEPS``."""
    start = replaced(" " + (text or ""), d.STEPS[:2])
    plain = parted(replaced(start, d.STEPS[2:5])).lower()
    blind = parted(regex.sub(d._BLIND_UNIT_PATTERN, r"\1 " + d.UNIT + r"\2\3", replaced(start, [d.STEPS[3]]).lower()))
    return [(k, [t for t in v.split(" ") if t]) for k, v in ((0, plain), (1, blind), (1, blind.replace(d.NAME, "")))]


def windows(text):
    """(kind, place, key) of every window of eight tokens, and whether more than half of it are slots."""
    for way, (kind, tokens) in enumerate(ways(text)):
        bare = [regex.sub(d.SLOT, r"\1", t) for t in tokens]
        for at in range(len(bare) - 7):
            key = tuple(bare[at : at + 8])
            yield kind, at, (way, key), sum(t in (d.NUMBER, d.NAME, d.UNIT) for t in key) > 4


def runs_of(met):
    """(place in the document, first, last, shift) of matched windows side by side on one diagonal."""
    out = []
    for shift, at in sorted(met):
        if out and out[-1][3] == shift and out[-1][2] + 1 == at:
            out[-1][2] = at
        else:
            out.append([at + shift, at, at, shift])
    return sorted(map(tuple, out))


def chains(runs, n_windows, n_words):
    """(windows, parts) of each diagonal alone and of each run's best chain, where they cover enough."""
    by_shift = defaultdict(list)
    for _, first, last, shift in runs:
        by_shift[shift].append((first, last))
    for shift, spans in by_shift.items():
        n = sum(last - first + 1 for first, last in spans)
        if n * 2 >= n_windows:
            yield n, [(shift, min(spans)[0], max(s[1] for s in spans))]
    best = []
    for pos, first, last, shift in runs:
        n = last - first + 1
        found = [(n + 7, n, -1, last, last + shift, [(shift, first, last)])]
        for words, m, _, c_last, c_end, parts in best:
            if pos - c_end > max(n_windows, 32) + 8 or last <= c_last or last + shift <= c_end:
                continue
            start = max(first, c_last + 1, c_end + 1 - shift)
            if parts[-1][0] == shift:
                longer = [*parts[:-1], (shift, parts[-1][1], last)]
            else:
                longer = [*parts, (shift, max(start, min(c_last + 8, last)), last)]
            found.append((words + min(last - start + 8, last - c_last), m + last - start + 1, -len(longer), last, last + shift, longer))
        best.append(max(found))
        words, m, *_, parts = best[-1]
        if m * 2 >= n_windows or words * 2 >= n_words or n >= 43:
            yield m, parts


def brute(docs, items):
    """Rows of ``contaminated`` without ids; ids are taken to be unique up to repeated rows."""
    docs = {k: t for k, t in docs if k is not None}
    items = {k: t for k, t in items if k is not None}
    wanted, places = defaultdict(set), defaultdict(set)
    for item, text in items.items():
        for kind, at, key, mostly in windows(text):
            if not mostly:
                wanted[key].add((item, at))
                places[item, kind].add(at)
    out = set()
    for doc, text in docs.items():
        met = defaultdict(set)
        for kind, pos, key, _ in windows(text):
            for item, at in wanted.get(key, ()):
                met[item, kind].add((pos - at, at))
        best = {}
        for (item, kind), pairs in met.items():
            ats = places[item, kind]
            n_words = len({at + k for at in ats for k in range(8)})
            own, theirs = ways(items[item])[kind][1], ways(text)[kind][1]
            for n, parts in chains(runs_of(pairs), len(ats), n_words):
                slots = [
                    (a, b) for shift, first, last in parts
                    for a, b in zip(own[first : last + 8], theirs[first + shift : last + shift + 8])
                    if a[0] == b[0] and a[0] in (d.NUMBER, d.NAME, d.UNIT)
                ]
                if len(set(slots)) == len({a for a, _ in slots}):
                    row = (doc, item, n, len(ats), len(slots), any(a != b for a, b in slots))
                    rank = (kind, -n, parts[0][0], parts)
                    best[item] = min(best.get(item, (rank, row)), (rank, row))
        out |= {row for _, row in best.values()}
    return out


def rows_of(frame):
    rows = [(r.doc_id, r.item_id, r.n_matched, r.n_windows, r.n_slots, r.reparameterised) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query(spark, folder):
    given = [
        [tuple(r) for r in spark.read.parquet(f"{folder}/{name}.parquet").select(key, "text").collect()]
        for name, key in (("documents", "doc_id"), ("benchmark", "item_id"))
    ]
    want = brute(*given)
    assert want and rows_of(QUERIES["op1_decontaminate"](spark, folder)) == want


ITEMS = [
    "Tom has 3 apples and walked 5 km to school before he gave 3 apples to his friend Ann at noon.",
    "A train leaves Paris at 9.30 and runs 120 km/h for 45 minutes; how far (in miles) does it get? Nobody knows, says Eve!",
    " ".join(f"w{k}" for k in range(60)),
    "a b a b a b a b a b a b a b a b a b a b",
    "$1,200.50 is 7 % of what? \"Ask Bob,\" said Ann: he paid 5kg, 6 Kg and 7 KG of it for 2 hours",
]


def edited(text, rng):
    words = text.split(" ")
    for _ in range(rng.randint(0, 4)):
        at = rng.randrange(len(words))
        what = rng.randrange(6)
        if what == 0:
            words.insert(at, "other")
        elif what == 1 and len(words) > 1:
            del words[at]
        elif what == 2:
            words[at] = str(rng.randrange(100))
        elif what == 3:
            words[at] = rng.choice(["Zoe", "(.5", "...", "kg", "5kg.", "É9", "?", "\x01x"])
        elif what == 4:
            words[at:at] = ["Then"] * rng.randrange(40)
        else:
            a, b = sorted(rng.choices(range(len(words)), k=2))
            words = words[b:] + words[a:b] + words[:a]
    text = " ".join(words) or "none"
    return rng.choice([str, str, str.upper, str.lower, str.title])(text)


@pytest.mark.parametrize("seed", [1, 2])
def test_edited_items(spark, seed):
    rng = random.Random(seed)
    texts = [rng.choice(["", "Before it.  ", "He said:\t"]) + edited(rng.choice(ITEMS), rng) for _ in range(150)]
    texts += [edited(rng.choice(ITEMS), rng) + ". " + edited(rng.choice(ITEMS), rng) for _ in range(50)]
    texts += [None, "", " ", "?!", "\x00 5 kg", ITEMS[0] + "\n" + ITEMS[0]]
    rows = [*enumerate(texts), (None, ITEMS[0]), (3, texts[3]), (3, texts[3])]
    items = [*enumerate(ITEMS), (20, None), (21, ""), (22, "too short for a window"), (23, ITEMS[0]), (None, ITEMS[2])]
    # other columns may be called like the operator's own
    given = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id int, text string, item int, keys string, kind int")
    bench = spark.createDataFrame([(*r, 1, "x", 2) for r in items], "item_id int, text string, doc int, way string, at int")
    want = brute(rows, items)
    assert len(want) > 100 and rows_of(d.contaminated(given, bench)) == want


def test_very_long_text(spark):
    filler = [f"u{k % 9973}" for k in range(150_000)]
    rows = [(1, " ".join([*filler[:100_000], ITEMS[1], *filler[100_000:]])), (2, " ".join(filler)), (3, "z" * 1_000_000)]
    items = list(enumerate(ITEMS))
    given = spark.createDataFrame(rows, "doc_id int, text string")
    want = brute(rows, items)
    assert {r[:2] for r in want} == {(1, 1)}
    assert rows_of(d.contaminated(given, spark.createDataFrame(items, "item_id int, text string"))) == want


def test_quick_steps_give_the_tokens_of_the_steps(spark):
    """The patterns for Java find what ``STEPS``, which the SQL uses, find; and no text is translated letter by letter."""
    rng = random.Random(4)
    marks = " \x01\x02\x03\t\n\r\x0b..,'%/!?:;ABaé1230-kmKM \x85 ÄßΣ–—‘“…·()[]\\^&{}~`|<>@#$*+=\"_¡«"
    words = ["5", "3.5km", "12 KM", "1,000", "km.", "%", "A", "$3", "a. B", "in", "5 in.", "9 %", "3 km/h,", "2 Hours!", "x:"]
    texts = ["".join(rng.choices(marks, k=rng.randrange(40))) for _ in range(2000)]
    texts += [" ".join(rng.choices(words, k=rng.randrange(14))) for _ in range(1000)]

    def parted(out):
        return d._replaced(F.translate(out, d.PARTING, " " * len(d.PARTING)), [d.STEPS[5]])

    start = d._replaced(F.concat(F.lit(" "), "t"), [d.STEPS[0], d.STEPS[1], d.STEPS[3]])
    slow = F.lower(parted(d._replaced(start, [d.STEPS[2], d.STEPS[4]])))
    slow_blind = parted(F.regexp_replace(F.lower(start), d._BLIND_UNIT_PATTERN, d.STEPS[4][1]))
    quick = d.marked(F.col("t"))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = df.select(d.valued(quick).alias("a"), d.blind_valued(quick).alias("b"))
    assert "translate(" not in found._jdf.queryExecution().executedPlan().toString()
    same = (d.tokens_of(d.valued(quick)) == d.tokens_of(slow)) & (d.tokens_of(d.blind_valued(quick)) == d.tokens_of(slow_blind))
    assert df.filter(~same).count() == 0


def test_only_texts_with_a_sign_become_templates(spark, monkeypatch):
    """A text without any sign of the benchmark's windows is left out before; no text that holds a window is."""
    rng = random.Random(5)
    items = [*ITEMS, "ΟΔΥΣΣΕΥΣ:Α ΠΑΣ’Β και ένας ΛΟΓΟΣ. τέλος οδός προς ΤΗΣ İstanbul ǅ", "§ Ann says § it § € 5 kg's don't-stop naïve co-op re:do x/y"]
    texts = [edited(rng.choice(items), rng) for _ in range(300)] + ["nothing of it is here, in 5 km of other words"] * 50
    bench = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc int, text string")
    wanted = {key for text in items for _, _, key, mostly in windows(text) if not mostly}
    holding = {k for k, text in enumerate(texts) if any(key in wanted for _, _, key, _ in windows(text))}
    kept = {r.doc for r in d.holding_signs(docs, "text", d.window_signs(bench, "text")).collect()}
    assert not [texts[k] for k in holding - kept]
    assert not [texts[k] for k in kept if k >= 300]

    with_signs = rows_of(d.contaminated(docs, bench, "doc").withColumnRenamed("doc", "doc_id"))
    monkeypatch.setattr(d, "SIGNED_WINDOWS", -1)
    assert rows_of(d.contaminated(docs, bench, "doc").withColumnRenamed("doc", "doc_id")) == with_signs != set()


def test_windows_without_words_keep_all_texts(spark):
    bench = spark.createDataFrame([(1, "§ € § € § € § € § €")], "item_id int, text string")
    docs = spark.createDataFrame([(1, "§ € § € § € § € § €"), (2, "words")], "doc_id int, text string")
    assert d.holding_signs(docs, "text", d.window_signs(bench, "text")).count() == 2
    assert {r[:2] for r in rows_of(d.contaminated(docs, bench))} == {(1, 1)}
