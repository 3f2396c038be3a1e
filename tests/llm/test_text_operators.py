"""Tests on small fixtures: brute force, exact round trips, held-out accuracy."""

import base64
import itertools
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import bisect, bpe, budget, defects, mixing, packing, similar, subjects

needs_vocabulary = pytest.mark.skipif(not os.path.isdir(bpe.TOKENIZERS), reason="the vocabularies aren't here")


# ---- tokens -----------------------------------------------------------------------------------
@needs_vocabulary
@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_counts_are_those_of_the_tokenizer(name):
    import tiktoken

    with open(f"{bpe.TOKENIZERS}/{name}", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    given = tiktoken.Encoding("t", pat_str=bpe.PIECES, mergeable_ranks=ranks, special_tokens={})
    own = bpe.TokenCounter(f"{bpe.TOKENIZERS}/{name}")
    rng = random.Random(1)
    texts = ["", " ", "a", "aaaaaaaaaaaaaaaa", "Hello,  world!\n\n\tdon't", "自第331天起，有了证据站点。" * 20, "🙂🙂 é ½ ² x_y", "x" * 5000, "<|endoftext|>"]
    texts += ["".join(rng.choice("abc 12.,\n äé漢字") for _ in range(rng.randrange(80))) for _ in range(300)]
    for t in texts:
        assert own.count(t) == len(given.encode_ordinary(t)), t
    assert own.count(None) == 0


def test_merging_by_hand():
    ranks = {b"ab": 0, b"bc": 1, b"abc": 2, b"cd": 3}
    assert bpe.surviving_symbols(b"abcd", ranks) == 2  # ab, then abc, then d
    assert bpe.surviving_symbols(b"bcd", ranks) == 2
    assert bpe.surviving_symbols(b"zz", ranks) == 2 and bpe.surviving_symbols(b"", ranks) == 0


@needs_vocabulary
def test_budget(spark):
    text = "The council gave crowns towards the relay. " * 20
    n = bpe.TokenCounter(f"{bpe.TOKENIZERS}/{bpe.VOCABULARY}").count(text)
    rows = [("a", n, text, "Open-Pages", "EN", "web"), ("a", n, text, "openpages", "en", "web"), ("b", 3 * n, text, None, "ger", ""), ("c", None, text, "x", None, None), ("d", 0, text, "x", "zh-CN", "w"), ("e", 2 * n, text, "x", "fr", "w"), ("f", n // 3, text, "x", "spa", "w"), (None, None, text, "x", "und", "w"), ("g", 5, None, "x", "it", "w")]
    counted = budget.counted(spark.createDataFrame(rows, "id string, token_count long, text string, source_dataset string, language string, domain string"))
    assert sorted(r["id"] for r in budget.wrong_counts(counted).collect()) == ["b", "c", "d", "f", "g"]
    assert {r["language"] for r in counted.collect()} == {"en", "de", "unknown", "zh", "fr", "es", "it"}
    totals = {(r["source_dataset"], r["language"], r["domain"]): (r["documents"], r["tokens"]) for r in budget.totals(counted).collect()}
    assert totals["*", "*", "*"] == (8, 7 * n) and totals["*", "en", "*"] == (1, n)
    assert sum(v[0] for k, v in totals.items() if "*" not in k) == 8
    empty = budget.counted(spark.createDataFrame([], "id string, token_count long, text string, source_dataset string, language string, domain string"))
    assert budget.wrong_counts(empty).count() == 0


@needs_vocabulary
def test_count_column_with_a_clashing_name(spark):
    df = spark.createDataFrame([(1, "hello world", 99), (2, None, 1)], "doc_id long, text string, Tokens long")
    n = bpe.TokenCounter(f"{bpe.TOKENIZERS}/{bpe.VOCABULARY}").count("hello world")
    assert n > 0 and [tuple(r) for r in bpe.with_tokens(df).collect()] == [(1, n), (2, 0)]


# ---- packing ----------------------------------------------------------------------------------
def packed_ok(rows, documents, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["pack_no"], []).append((r["start"], r["length"]))
    assert sorted(by) == list(range(len(by)))
    for own in by.values():
        at = 0
        for start, length in sorted(own):
            assert start == at
            at += length
        assert at <= capacity
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], []).append((r["part"], r["first_token"], r["length"]))
    for doc, tokens in documents:
        parts = sorted(got.get(doc, []))
        assert sum(n for *_, n in parts) == (tokens or 0)
        assert len(parts) == (0 if not tokens else -(-tokens // capacity))
        at = 0
        for _, first, n in parts:
            assert first == at
            at += n


@pytest.mark.parametrize("capacity", [1, 7, 64])
def test_packing(spark, capacity):
    rng = random.Random(capacity)
    documents = [(i, rng.choice([0, None, 1, 5, 7, 33, 64, 65, 200, rng.randrange(1, 64)]) if i % 3 else 5) for i in range(500)]
    rows = packing.pack(spark.createDataFrame(documents, "doc_id long, tokens long"), capacity).collect()
    packed_ok(rows, documents, capacity)
    report = packing.fill_report(spark.createDataFrame(rows), capacity).first()
    assert report["packs"] <= report["least"] * 1.25 + 1


def test_packing_nothing(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, tokens long"), 8).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 1)], "doc_id long, tokens long"), 0)


def test_plan_uses_every_length_once():
    rng = random.Random(4)
    for _ in range(50):
        histogram = Counter(rng.randrange(1, 33) for _ in range(rng.randrange(1, 400)))
        plan = packing.plan_packs(dict(histogram), 32)
        used = Counter()
        for count, lengths in plan:
            assert sum(lengths) <= 32
            for n in lengths:
                used[n] += count
        assert used == histogram
        lengths, ranks, containers, starts = packing.places(plan)
        assert len(lengths) == sum(len(x) for _, x in plan)


# ---- mixing -----------------------------------------------------------------------------------
def test_mixing(spark):
    rng = random.Random(2)
    rows = [(i, ("Big Source", "big-source", "BIG_SOURCE")[i % 3] if i % 4 else ("small" if i % 8 else "tiny"), rng.randrange(1, 200)) for i in range(4000)] + [(5000, None, 10), (5001, "other", 10), (5002, "small", None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, tokens long")
    targets = spark.createDataFrame([("big_source", 0.5, 1), ("small", 0.25, 3), ("tiny", 0.2, 1), ("absent", 0.05, 9)], "source string, target_share double, max_repeats int")
    chosen = mixing.mix(docs, targets).collect()
    caps, repeats = {"big_source": 1, "small": 3, "tiny": 1}, Counter()
    for r in chosen:
        assert 1 <= r["copies"] <= caps[r["source"]]
        repeats[r["source"]] += r["copies"]
    total = sum(t or 0 for _, _, t in rows)
    has = Counter()
    number = Counter()
    for _, s, t in rows:
        name = mixing_name(s)
        has[name] += t or 0
        number[name] += 1
    for s, share in (("big_source", 0.5), ("small", 0.25), ("tiny", 0.2)):
        rate = min(caps[s], share * total / has[s])
        assert abs(repeats[s] - rate * number[s]) <= 1.01
    named = docs.withColumn("source", mixing.source_name(F.col("source")))
    short = {r["source"] for r in mixing.shares(mixing.mix(named, targets), mixing.sizes(named, targets)).where("falls_short").collect()}
    assert short == {s for s, share, cap in (("big_source", 0.5, 1), ("small", 0.25, 3), ("tiny", 0.2, 1), ("absent", 0.05, 9)) if has[s] * cap < share * total}
    assert mixing.mix(docs.where("false"), targets).count() == 0


def test_small_budgets_and_copies_as_rows(spark):
    docs = spark.range(0, 20_000).select(F.col("id").alias("doc_id"), F.lit("web").alias("source"), F.lit(1000).alias("tokens"))
    targets = spark.createDataFrame([("web", 1.0, 3)], "source string, target_share double, max_repeats int")
    assert mixing.mix(docs, targets, budget=5_000).count() == 5  # a rate of 0.00025
    assert mixing.mix(docs, targets, budget=400).count() <= 1  # 0.4 of a copy in all: a rate of 0.00002
    rows = mixing.mix(docs, targets, budget=50_000_000, rows=True)
    assert rows.count() == 50_000 and {r["copy"] for r in rows.select("copy").distinct().collect()} == {1, 2, 3}
    assert mixing.mix(docs, targets, budget=10**12).agg(F.sum("copies")).first()[0] == 60_000
    rare = sum(mixing.mix(docs, targets, seed=s, budget=10_000_000 // 1_000_000).count() for s in range(3))  # a rate of 5e-7: below half a millionth
    assert rare <= 3


def mixing_name(s):
    return s and s.strip().lower().replace("-", "_").replace(" ", "_")


# ---- pairs ------------------------------------------------------------------------------------
def test_blank_refused_and_copied():
    for a in (None, "", " \n", "​", "N/A", "...", "[no response]", '""', "-", "⁠ ‍"):
        assert defects.is_blank(a), repr(a)
    for a in ("No", "7", "🙂", "是。", "none of them"):
        assert not defects.is_blank(a), a
    for a in ("I'm sorry, but I can't help with that.", "Good question. I cannot provide information on this subject.", "Dazu darf ich leider keine Auskunft geben.", "En tant qu'assistant, je dois refuser.", "Lo siento, no puedo ayudar con eso.", "抱歉，我无法回答这个问题。", "MY GUIDELINES DON’T ALLOW ME TO RESPOND HERE."):
        assert defects.is_refusal(a), a
    for a in ("I'm sorry to hear about the trouble. The broker was never reported.", "I can't say it more simply: we rotate the beans every third year.", "Many refuse to help here, yet it is easy.", "Gravity alone cannot account for how the cell bends.", "没有磁场，这个假说无法检验。"):
        assert not defects.is_refusal(a), a
    q = "Water is scarce here. Which comes first, the barn or the compost?"
    for a in (q, q.upper(), f'"{q}"', f"You asked: {q}", f"{q} {q}", "Which comes first, the barn or the compost"):
        assert defects.is_copy(q, a), a
    for a in (f"{q} They moved the tractor next to the barn before the cold came.", "The barn.", "No", "The compost comes first, then the barn."):
        assert not defects.is_copy(q, a), a


def test_short_copies_and_long_quotes():
    for q, a in (("Why is it?", "why is it?"), ("Was ist das?", "Was ist das?"), ("How do I fix this bug?", "Your question was: How do I fix this bug?"), ("Why so?", "Why so?")):
        assert defects.is_copy(q, a), a
    for q, a in (("Is it the barn?", "It is the barn."), ("Why so?", "Why so: because the barn fell down.")):
        assert not defects.is_copy(q, a), a
    q = "What is known about " + "the barn and the orchard and " * 20 + "the well?"
    assert defects.is_refusal(f"I'm sorry, but I can't answer the question {q}", q)
    assert not defects.is_refusal("I can't help but say that " * 40, q)


def test_very_long_answers():
    long = "I can't help but say that " * 40_000
    assert not defects.is_refusal(long) and not defects.is_copy("What is it?", long) and not defects.is_blank(long)
    assert defects.is_copy("why so " * 20_000, "why so " * 20_000)
    assert defects.context(long) == "letter closed plain many"


def conversations(spark, rows):
    return spark.createDataFrame([("t", i, m, "x") for i, m in enumerate(rows)], "table_name string, record_no long, messages array<struct<role:string,content:string>>, defect string")


def test_defects_of_planted_pairs(spark):
    en, de = "The orchard needs water in spring and the barn has to be mended before the first frost.", "Die Bäuerin sicherte die Setzlinge vor dem ersten Frost und der Traktor war nicht zu retten."
    sound = [("user", f"What do I need to know about the barn number {i} and the orchard?") for i in range(1)]
    rows = [[("user", f"Why does the field number {i} matter more than the barn for the farmer?"), ("assistant", f"{en} It took {i} days.")] for i in range(60)]
    rows += [[("user", f"Warum sind die Felder {i} wichtiger als die Scheune für den Hof?"), ("assistant", f"{de} Es dauerte {i} Tage.")] for i in range(60)]
    first = len(rows)
    rows += [
        [("user", sound[0][1]), ("assistant", de)], [("user", sound[0][1]), ("assistant", en[:60])], [("user", sound[0][1])], None, [], [(None, "Bitte auf Englisch antworten: Was ist mit dem Hof?"), (None, en)],
        [("system", "x"), ("human", sound[0][1]), ("bot", "Yes."), ("USER ", sound[0][1]), ("model", "null")], [("user", sound[0][1]), ("assistant", "1. barn\n2. orchard\n3. field")], [None, ("assistant", en)],
        [("user", sound[0][1]), ("assistant", "```python\ndef f(rows):\n    for r in ro")],
    ]
    got = sorted((r["record_no"] - first, r["msg_pos"], r["defect"]) for r in defects.defective_pairs(conversations(spark, rows)).collect())
    assert got == [(0, 0, "other_language"), (1, 0, "truncated"), (2, 0, "empty"), (3, -1, "empty"), (4, -1, "empty"), (6, 3, "empty"), (9, 0, "truncated")]
    assert defects.defective_pairs(conversations(spark, [])).count() == 0


def test_roles():
    assert defects.tidy_roles([None, None, None]) == ["system", "user", "assistant"]
    assert defects.tidy_roles([None, None, "user", ""]) == ["user", "assistant", "user", "assistant"]
    assert defects.tidy_roles(["system", None, "bot"]) == ["system", "user", "assistant"]
    assert defects.tidy_roles([]) == []


@pytest.mark.parametrize("question", ["Why?", "Is it?", "Warum?", "What is X?", "為什麼?", "¿Qué?", "How do I fix this bug?"])
def test_copies_of_short_questions(question):
    assert defects.is_copy(question, question) and defects.is_copy(question, f"Your question was: {question}") and defects.is_copy(question, f'"{question.upper()}"')
    assert not defects.is_copy(question, f"{question} Because the pump is broken.")


def test_compression_tells_what_an_answer_adds():
    q = "which comes first, the barn or the compost"
    for asked in ("why", "is it", q, "為什麼", q * 50):
        assert defects.own_share(asked, asked) <= 0.1, asked
        for new in ("292", "no", "xyz quick jumps"):
            assert defects.own_share(asked, new) >= 0.8, (asked, new)
    rng = random.Random(3)
    far = " ".join(f"w{rng.randrange(10**6)}" for _ in range(400_000))  # 3 MB: beyond the usual window
    assert defects.own_share(far, far) <= 0.1


def test_copies_that_are_not_in_one_piece():
    q = "Water is scarce here. Which comes first, the barn or the compost?"
    for a in ("Which comes first, the barn or the compost? Water is scarce here.", "You asked: Which comes first, barn or compost?", "Which comes first, barn or compost? Which comes first, barn or compost?"):
        assert defects.is_copy(q, a), a
    for a in ("The compost comes first, the barn is scarce.", "First the barn, the compost comes.", "Which comes first, the barn or the tractor?", "First, the barn.", "Water is scarce."):
        assert not defects.is_copy(q, a), a


def test_refusals_of_any_length():
    long = "I'm sorry, but " + "given all that has been said about it in this conversation so far " * 20
    assert defects.is_refusal(long + "I cannot help with that request.")
    assert not defects.is_refusal(long + "the pump is broken.")


#: Refusals that the dictionary was not written from.
HELD_OUT = [
    "I'm afraid I can't assist you with this topic.", "As an AI language model, I cannot provide an answer to this question.", "I am not able to discuss that subject.", "We must refuse to comment on that.",
    "Answering this would go against my guidelines.", "Sorry, that is not something I can do.", "Ich kann diese Frage leider nicht beantworten.", "Dabei darf ich Ihnen nicht weiterhelfen.",
    "Ich bin nicht befugt, darüber Auskunft zu geben.", "Je ne peux pas répondre à cette question.", "Je ne suis pas autorisé à en parler.", "Cela dépasse ce que je peux dire.",
    "No puedo ayudarle con esa solicitud.", "Lo siento, no estoy autorizado a hablar de ese tema.", "Esto va más allá de lo que puedo decir.", "对不起，我不能回答这个问题。", "我们换个话题吧。", "Non posso rispondere a questa domanda.",
    "Não posso responder a essa pergunta.", "Я не могу ответить на этот вопрос.",
]
SOUND = ["You cannot skip this step.", "Many refuse to help here, yet it is easy.", "Der Anwalt konnte den Vertrag nicht kündigen.", "Le juge ne peut pas annuler la vente.", "El contrato no puede firmarse antes.", "没有磁场，这个假说无法检验。", "The lender refused to extend the loan."]


def test_held_out_refusals():
    found = [x for x in HELD_OUT if defects.is_refusal(x)]
    assert len(found) >= 0.9 * len(HELD_OUT), set(HELD_OUT) - set(found)
    assert not [x for x in SOUND if defects.is_refusal(x)]


# ---- similar records --------------------------------------------------------------------------
def planted(seed, groups=25):
    """Texts of which those of a group share names and numbers, in their own words and order."""
    rng = random.Random(seed)
    syllables = ["ba", "kor", "lim", "tu", "zen", "rop", "mi", "sal", "vok", "dri", "hun", "plo"]
    frames = ["the council of {p} gave {a} crowns", "the {t} costs {b} crowns", "{f} opened a site in {p} on day {d}", "some {a} people in {p} want the {t}", "{f} calls the {t} its answer", "until {y} the {t} will stay in {p}"]
    filler = ["it took longer than anyone had thought", "more on this will follow", "this was not the plan", "others tell it differently"]
    rows, truth = [], {}
    name = lambda: "".join(rng.choice(syllables) for _ in range(5))
    for g in range(groups):
        own = {"p": name(), "f": name(), "t": name(), "a": rng.randrange(10_000, 99_999), "b": rng.randrange(1000, 9999), "d": rng.randrange(365), "y": rng.randrange(2030, 2090)}
        for _ in range(rng.choice((1, 2, 6, 12))):
            said = [f.format(**own) for f in rng.sample(frames, rng.choice((4, 5, 6)))] + rng.sample(filler, 2)
            rng.shuffle(said)
            rows.append((f"r{len(rows):04d}", ". ".join(said)))
            truth[rows[-1][0]] = g
    return rows, truth


SHAPE = "id string, text string"


def pairs_of(groups):
    return {(r["id_a"], r["id_b"]) for r in similar.similar_pairs(groups).collect()}


@pytest.mark.parametrize("bounds", [{}, {"node_rows": 60, "block_rows": 5}, {"node_rows": 60, "planes": 1}])
def test_similar_pairs_against_the_planted_groups(spark, bounds):
    """Whatever fits into a task, a block or a broadcast, the same is found."""
    rows, truth = planted(5)
    df = spark.createDataFrame([(i, t, "u") for i, t in rows] + [(rows[0][0], rows[0][1], None), (None, "x", None), ("empty", "", None), ("null", None, None)], "id string, text string, url string")
    groups = similar.similar_groups(df, **bounds)
    pairs = pairs_of(groups)
    wanted = {(a, b) for (a, _), (b, _) in itertools.combinations(rows, 2) if truth[a] == truth[b]}
    assert all(a < b for a, b in pairs)
    assert len(pairs & wanted) >= 0.97 * len(wanted)
    assert len(pairs - wanted) <= 0.03 * len(pairs)
    members = groups.members.collect()
    assert sorted(r["id"] for r in members) == sorted([i for i, _ in rows] + ["empty"])
    size = Counter(r["group_id"] for r in members)
    report = {r["leaf"]: (r["records"], len(r["typical"])) for r in similar.group_report(groups).collect()}
    assert report == {g: (n, min(n, 3)) for g, n in size.items() if n > 1}


def test_copies_are_linked_to_one_of_them(spark):
    rows, _ = planted(6, 4)
    text = rows[0][1]
    df = spark.createDataFrame([(f"c{i:03d}", text if i % 2 else f" {text} ") for i in range(200)] + rows + [("lone1", "one of a kind"), ("lone2", "one of a  kind")], SHAPE)
    groups = similar.similar_groups(df)
    copies = [r for r in groups.members.collect() if r["copy_of"] is not None]
    assert Counter(r["copy_of"] for r in copies) == {"c000": 200, "lone1": 1}
    report = {r["leaf"]: (r["records"], r["typical"]) for r in similar.group_report(groups).collect()}
    assert report["lone1"] == (2, ["lone1"])  # a text and its copy are a group
    assert sum(n for n, _ in report.values()) == sum(n for n in Counter(r["group_id"] for r in groups.members.collect()).values() if n > 1)
    none = similar.similar_groups(df.where("false"))
    assert none.members.count() == 0 and not pairs_of(none) and similar.group_report(none).count() == 0


def test_words_of_one_record_alone_hide_nothing(spark):
    rows, _ = planted(7, 10)
    shared = " ".join(f"shared{i}x" for i in range(10))
    rows += [(f"z{k}", shared + " " + " ".join(f"alone{k}y{i}" for i in range(14))) for k in range(3)]
    assert {("z0", "z1"), ("z0", "z2"), ("z1", "z2")} <= pairs_of(similar.similar_groups(spark.createDataFrame(rows, SHAPE)))


@pytest.mark.parametrize("bounds", [{}, {"node_rows": 40, "planes": 1, "block_rows": 17}])
def test_a_matter_larger_than_a_node_stays_whole(spark, bounds):
    rows = [(f"n{k:03d}", f"nothing{k}x unlike{k}y this{k}z") for k in range(60)]  # they share nothing with any other
    for m in "uv":  # two matters of three times a node's rows: five words that all share and one of each text's own
        rows += [(f"{m}{k:03d}", " ".join(f"{m}word{i}x" for i in range(5)) + f" {m}own{k}") for k in range(120)]
    groups = similar.similar_groups(spark.createDataFrame(rows, SHAPE), **bounds)
    pairs = pairs_of(groups)
    for m in "uv":
        assert {(f"{m}{a:03d}", f"{m}{b:03d}") for a, b in itertools.combinations(range(120), 2)} <= pairs
    names = {m: {r["group_id"] for r in groups.members.collect() if r["id"][0] == m} for m in "uvn"}
    assert names["u"] == {"u000"} and names["v"] == {"v000"} and len(names["n"]) == 60


def vectors(owner, width=8):
    import numpy as np

    n = len(owner)
    return np.arange(0, width * n + 1, width), (owner[:, None] * width + np.arange(width)).ravel(), np.full(n * width, width**-0.5), bisect.mixed(np.arange(n), 3)


def test_bisecting_separates_what_shares_nothing():
    import numpy as np

    owner = np.repeat(np.arange(50), 6)
    leaf = bisect.bisect(*vectors(owner), 0.3)
    assert len(set(zip(owner.tolist(), leaf.tolist(), strict=True))) == len(set(leaf.tolist())) == 50
    indptr, indices, data, ids = vectors(np.arange(7))
    assert len(set(bisect.bisect(indptr, indices, data, ids, 0.3).tolist())) == 7  # rows alone are leaves
    assert len(bisect.bisect(indptr[:1], indices[:0], data[:0], ids[:0], 0.3)) == 0


def test_a_compact_node_is_a_leaf_whatever_its_size():
    import numpy as np

    n = 20_000
    indices = np.tile(np.arange(4), (n, 1))
    indices[:, 3] = 100 + np.arange(n)  # a quarter of each row is its own: a mean similarity of 0.75
    assert bisect.bisect(np.arange(0, 4 * n + 1, 4), indices.ravel(), np.full(4 * n, 0.5), bisect.mixed(np.arange(n), 1), 0.3).max() == 0


def test_small_leaves_are_checked_like_large_ones():
    import numpy as np

    rng = np.random.default_rng(4)
    leaf = np.repeat(np.arange(30), rng.integers(2, similar.SMALL + 1, 30))
    n = len(leaf)
    indices = np.stack([rng.choice(12, 5, replace=False) for _ in range(n)])
    indices.sort(1)
    data = rng.random((n, 5)) + 0.1
    data /= np.sqrt((data**2).sum(1))[:, None]
    indptr = np.arange(0, 5 * n + 1, 5)
    label, total, first, second = similar.small_leaves(leaf, (indptr, indices.ravel(), data.ravel()), 0.6, 0.4)
    for k in range(30):
        rows = np.flatnonzero(leaf == k)
        part = bisect.take(indptr, indices.ravel(), data.ravel(), rows)
        same = similar.similarities(*part)
        own = similar.connected(same >= 0.6)
        assert (label[rows] == rows[own]).all()
        together = own[:, None] == own[None, :]
        assert np.allclose(total[rows], (same * together).sum(1), atol=1e-5)
        i, j = np.nonzero(np.triu(together & (same >= 0.4), 1))
        mine = leaf[first] == k
        assert set(zip(rows[i].tolist(), rows[j].tolist(), strict=True)) == set(zip(first[mine].tolist(), second[mine].tolist(), strict=True))


# ---- subjects ---------------------------------------------------------------------------------
WORDS = {"law": "court verdict witness appeal statute tribunal", "sport": "penalty goalkeeper league podium referee sprint"}
SAYS = {"law": ["the judge reserved judgment on the {0}", "counsel argued that the {0} could not override the {1}", "a {0} must be lodged within # days"], "sport": ["the coach kept faith with the {0} despite the {1}", "fans sang as the {0} rolled into extra time", "after the {0} the team climbed to place #"]}


def corpus(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        have = [s for s in WORDS if rng.random() < 0.5]
        said = [rng.choice(SAYS[s]).format(*rng.sample(WORDS[s].split(), 2)) for s in have for _ in range(rng.choice((2, 4)))]
        if rng.random() < 0.3:
            other = rng.choice(list(WORDS))
            if other not in have:
                said.append(rng.choice(SAYS[other]).format(*rng.sample(WORDS[other].split(), 2)))
        said += rng.sample(["more on this will follow next week", "it took longer than anyone had thought", "that was not the plan", "comments are open until friday"], 2)
        rng.shuffle(said)
        out.append((i, ". ".join(said) + ".", have))
    return out


def test_subjects_on_held_out_documents(spark):
    rng = random.Random(9)
    rows = corpus(1, 400)
    code = "import json\nimport os\n# the coach kept faith with the penalty despite the league\ndef load_goalkeeper(rows):\n    referee = []\n    return referee\n"
    labels = [(i, s, "a", 2) for i, _, have in rows[:250] for s in (have or ["none"]) if rng.random() > 0.05] * 2
    areas = spark.createDataFrame([("law", "Law"), ("sport", "Sport"), ("software", "Software")], "subject string, title string")
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(1000, code, "x"), (1001, None, "x"), (1002, "", "x")], "doc_id long, text string, subject string")
    given = spark.createDataFrame(labels, "doc_id long, subject string, rater string, confidence int")
    found = subjects.subjects_of(docs, given, areas)
    got = {(r["doc_id"], r["subject"]) for r in found.collect()}
    wanted = {(i, s) for i, _, have in rows[250:] for s in have}
    mine = {(i, s) for i, s in got if 250 <= i < 1000}
    assert len(mine & wanted) >= 0.95 * len(wanted) and len(mine - wanted) <= 0.05 * len(mine)
    assert (1000, "software") in got and (1000, "sport") in got and not [x for x in got if x[0] > 1000]
    makeup = {r["subject"]: r["documents"] for r in subjects.makeup(found, docs).collect()}
    assert makeup["software"] == 1 and makeup["none"] >= 2
    assert subjects.subjects_of(docs.where("false"), given, areas).count() == 0
    assert {r["subject"] for r in subjects.subjects_of(docs, given.where("false"), areas).collect()} == {"software"}


def test_texts_that_share_nothing_of_their_rarest_words(spark):
    """Words that few others have take all places of the vectors for clustering; what the texts have in common comes after them."""
    rows = [(f"n{k:03d}", f"nothing{k}x unlike{k}y this{k}z") for k in range(400)]
    shared = " ".join(f"shared{i}x" for i in range(70))
    for k in range(16):
        rare = [f"rare{k}y{i}" for i in range(12)]
        rows.append((f"z{k:02d}", shared + " " + " ".join(rare)))
        rows += [(f"p{k:02d}w{i:02d}", f"{w} other{k}v{i}a other{k}v{i}b") for i, w in enumerate(rare)]
    df = spark.createDataFrame(rows, SHAPE)
    wanted = set(itertools.combinations([f"z{k:02d}" for k in range(16)], 2))
    for bounds in ({}, {"block_rows": 5}):  # lists of more than five rows are dealt
        groups = similar.similar_groups(df, **bounds)
        assert pairs_of(groups) == wanted
        report = {r["leaf"]: (r["records"], len(r["typical"])) for r in similar.group_report(groups).collect()}
        assert report == {"z00": (16, 3)}
