"""Toxicity, language and masked scoring: held-out results and brute force."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from rollsight.llm import catalog, langid, masked_lm, toxicity
from tests.llm.rows import empty_documents, odd_documents

SF_DIR = "/root/testdata/sf0.1"


def crc(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_toxicity_on_held_out_documents(spark):
    got = {r["doc_id"]: r for r in catalog.QUERIES["op1_counterfactual_toxicity"](spark, SF_DIR).collect()}
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(r["held_out"] == (crc(d, 5) == 0) and 0 <= r["score"] <= 1 for d, r in got.items())
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    held = [(got[r["doc_id"]]["score"], r["toxic"]) for r in labels if crc(r["doc_id"], 5) == 0]
    toxic, clean = ([s for s, y in held if y == k] for k in (1, 0))
    auc = np.mean([(t > c) + 0.5 * (t == c) for t in toxic for c in clean])
    assert auc > 0.97, auc
    assert np.mean([t >= 0.5 for t in toxic]) > 0.85 and np.mean([c >= 0.5 for c in clean]) < 0.01


def labelled(spark, n=300):
    """Toxic texts name the first group more often than clean ones do."""
    draw, rows = np.random.default_rng(0), []
    for k in range(n):
        toxic = k % 2
        group = "gay" if draw.random() < (0.8 if toxic else 0.1) else "straight"
        filler = " ".join(draw.choice(["river", "stone", "cloud", "paper", "glass", "field"], 8))
        insult = draw.choice(["idiot", "scum"]) if toxic and draw.random() < 0.8 else "neighbour"
        rows.append((f"the {group} person is my {insult} {filler}", int(toxic)))
    return spark.createDataFrame(rows, "text string, toxic int")


def test_swaps_take_the_group_out_of_the_score(spark):
    rows = labelled(spark)
    free, bound = toxicity.fit(rows, swap_weight=0.0), toxicity.fit(rows, swap_weight=10.0)
    gap = lambda m, rest: abs(
        toxicity.score_text(f"the gay person is my {rest}", m) - toxicity.score_text(f"the straight person is my {rest}", m)
    )
    assert gap(free, "neighbour river") > 0.2 and gap(bound, "neighbour river") < 0.05
    assert toxicity.score_text("the gay person is my neighbour river", bound) < 0.5
    assert toxicity.score_text("the straight person is my idiot river", bound) > 0.5


def test_pairs_differ_in_the_named_group_only():
    pair = toxicity.counterfactual(toxicity.IDENTITY_TERMS)
    assert pair("Gay men sing.") == ("Gay men sing.", "straight women sing.")
    assert pair(None) is None and pair("") is None and pair(" .\n!") is None
    kind_of = {t: k for k, kind in enumerate(toxicity.IDENTITY_TERMS) for t in kind}
    for text in ("One river. Two stones!", "x", "eins zwei\ndrei", "é" * 9):
        a, b = (t.split() for t in pair(text))
        (at,) = [k for k, (u, v) in enumerate(zip(a, b)) if u != v]
        assert kind_of[a[at]] == kind_of[b[at]] and a[:at] + a[at + 1:] == b[:at] + b[at + 1:]
        assert pair(text) == pair(text)
    assert toxicity.counterfactual(())("one two") is None


def test_slope_is_that_of_the_loss_written_out(spark):
    """Fifty rows: the loss over texts and their pairs, feature by feature, differentiated in steps."""
    rows = labelled(spark, 50).collect() + [("no group here at all", 0), ("scum of the river", 1)]
    places = np.full(toxicity.SLOTS, -1, dtype=np.int32)
    used = np.unique(np.concatenate([toxicity.slots_of(r[0]) for r in rows]))[::3]
    places[used] = np.arange(len(used))
    frame = next(toxicity._design(places, toxicity.IDENTITY_TERMS)(
        [__import__("pandas").DataFrame([tuple(r) for r in rows], columns=["text", "toxic"])]
    ))
    sets = [toxicity._Rows(frame[c], len(used)) for c in ("own", "plus", "minus")]
    y = np.array([float(r[1]) for r in rows])
    share = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    pair = toxicity.counterfactual(toxicity.IDENTITY_TERMS)

    def plain(values):
        total = 0.005 * sum(v * v for v in values[:-1])
        z_of = lambda t: sum(values[places[k]] for k in set(toxicity.slots_of(t).tolist()) if places[k] >= 0) + values[-1]
        for (text, toxic), weight in zip(rows, share):
            z = z_of(text)
            total += weight * math.log1p(math.exp(-z if toxic else z))
            a, b = pair(text)
            total += 3.0 * (z_of(a) - z_of(b)) ** 2 / len(rows)
        return total

    at = np.random.default_rng(1).normal(0, 0.3, len(used) + 1)
    got = toxicity._Loss(*sets, y, share, 3.0, 0.01).slope(at[:-1], at[-1])
    for k in [*range(0, len(used), 7), len(used)]:
        step = np.zeros(len(at))
        step[k] = 1e-5
        assert got[k] == pytest.approx((plain(at + step) - plain(at - step)) / 2e-5, abs=1e-6)


def test_swaps_hardly_move_the_query_model(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    rows = toxicity.training_rows(docs, labels.where(catalog.remainder("doc_id", 5) != 0))
    model = toxicity.fit(rows)
    assert model.pairs > 0.5 * rows.count()
    held = docs.join(labels.where(catalog.remainder("doc_id", 5) == 0), "doc_id").select("text").collect()
    pair = toxicity.counterfactual(toxicity.IDENTITY_TERMS)
    both = [pair(r["text"]) for r in held if pair(r["text"])]
    gaps = [abs(toxicity.score_text(a, model) - toxicity.score_text(b, model)) for a, b in both]
    assert max(gaps) < 0.05, max(gaps)


def test_toxicity_of_odd_rows(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 1, 1), (2, 1, 1), (3, 0, None), (6, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int"
    )
    rows = toxicity.training_rows(docs, labels)
    # Contradicting, missing and nameless labels are not used.
    assert sorted(r["toxic"] for r in rows.collect()) == [0, 1]
    model = toxicity.fit(rows)
    kept = toxicity.not_toxic(docs, model, threshold=1.1)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    empty = toxicity.fit(toxicity.training_rows(empty_documents(spark), labels))
    scores = [toxicity.score_text(t, empty) for t in ("", None, "some text")]
    assert scores == [0.5] * 3
    assert toxicity.not_toxic(empty_documents(spark), model).count() == 0


def plain_grams(text):
    """Letter n-grams of the test's texts, which are lower-case a-z and blanks."""
    line, found = f" {text} ", Counter()
    for n in (1, 2, 3):
        for k in range(len(line) - n + 1):
            gram = line[k:k + n]
            if " " not in gram[1:-1] and gram.strip() and (n > 1 or gram != " "):
                found[gram] += 1
    return found


def code(gram):
    value = 0
    for c in gram:
        value = value << 8 | (0 if c == " " else ord(c) - 96)
    return value + ((len(gram) - 1) << 24)


def ranked(counts, top):
    return sorted(counts, key=lambda g: (-counts[g], code(g)))[:top]


def test_no_two_letters_share_a_symbol():
    letters = "zźżžuůűtťŧũūŭųŵŷſıłабгαβγ中文字ab"
    assert len(set(langid.symbols(letters)[1:-1].tolist())) == len(set(letters.lower()))
    found = langid.grams(langid.symbols("ab źż 中"))
    # Per word of n letters: n single ones, n + 1 pairs and n triples.
    assert len(set(found.tolist())) == len(found) == 5 + 8 + 5 and found.min() > 0


def test_distance_equals_brute_force(spark):
    learned = [("ab", "abba ab aab bab"), ("ab", "baab ab"), ("cd", "cdc dcd ccd cab"), (None, "zzz zz")]
    frame = spark.createDataFrame(learned, "lang string, text string")
    profiles = langid.learn(frame, length=12)
    assert profiles.languages == ["ab", "cd"]
    text = "abc cab dab dac"
    mine = ranked(plain_grams(text), 10)
    got = langid.distances(text, profiles, top=10)
    for k, lang in enumerate(profiles.languages):
        counts = Counter()
        for name, t in learned:
            if name == lang:
                counts.update(plain_grams(t))
        theirs = ranked(counts, 12)
        away = [abs(theirs.index(g) - r) if g in theirs else 12 for r, g in enumerate(mine)]
        assert got[k] == pytest.approx(sum(away) / len(mine) / 12)


def test_language_on_held_out_documents(spark):
    got = catalog.QUERIES["op2_rank_order_language"](spark, SF_DIR).collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(got) == len(lang)
    assert all(r["held_out"] == (crc(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 for r in got)
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in got if r["held_out"]]
    assert np.mean(held) > 0.97, np.mean(held)


def test_language_of_odd_rows(spark):
    docs = odd_documents(spark)
    profiles = langid.learn(docs)
    found = docs.select("doc_id", langid.language("text", profiles).alias("f")).select("doc_id", "f.*").collect()
    assert {r["doc_id"]: r["lang"] for r in found if r["doc_id"] in (3, 4, 5)} == {3: "und", 4: "und", 5: "und"}
    assert all(r["lang"] == "en" for r in found if r["doc_id"] in (1, 2, 6, 7, 11))
    nothing = langid.learn(empty_documents(spark))
    assert docs.select(langid.language("text", nothing)["lang"].alias("l")).distinct().collect()[0]["l"] == "und"


def test_masked_probabilities(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    words = masked_lm.count_words(docs)
    assert len(set(words.class_of.tolist())) == masked_lm.CLASSES
    mass = np.bincount(words.class_of, np.exp(words.within.astype(float)), minlength=masked_lm.CLASSES)
    np.testing.assert_allclose(mass, 1, rtol=1e-3)
    net = masked_lm.first_network()
    around = np.array([[64, 3], [1, 2], [5, 6], [7, 64]])
    every = [masked_lm.log_probabilities(net, around, np.full(2, c)) for c in range(masked_lm.CLASSES)]
    np.testing.assert_allclose(np.exp(every).sum(axis=0), 1, rtol=1e-5)
    text = "the and of to the"
    slots = [zlib.crc32(w.encode()) % masked_lm.SLOTS for w in text.split()]
    classes = [64, 64, *[int(words.class_of[s]) for s in slots], 64, 64]
    total = 0.0
    for k, slot in enumerate(slots):
        h = net.hidden.astype(float).copy()
        for place, offset in enumerate((-2, -1, 1, 2)):
            h += net.places[place][classes[k + 2 + offset]]
        z = np.tanh(h) @ net.out + net.bias
        total += z[classes[k + 2]] - math.log(np.exp(z).sum()) + words.within[slot]
    got = spark.createDataFrame([(text,), (None,), ("",)], "text string").select(
        masked_lm.pseudo_likelihood("text", words, net).alias("f")
    ).select("f.*").collect()
    assert got[0]["n_words"] == 5 and got[0]["log_likelihood"] == pytest.approx(total, rel=1e-4)
    assert [tuple(r) for r in got[1:]] == [(0, 0.0), (0, 0.0)]


def test_slopes_are_those_of_the_loss():
    net = masked_lm.first_network()
    draw = np.random.default_rng(1)
    around, middle = draw.integers(0, 65, (4, 50)), draw.integers(0, 64, 50)
    slopes = masked_lm._slopes(net, around, middle)
    loss = lambda n: -masked_lm.log_probabilities(n, around, middle).astype(float).mean()
    for part, spot in ((0, (1, int(around[1, 0]), 3)), (1, (4,)), (2, (2, int(middle[0]))), (3, (int(middle[1]),))):
        moved = [masked_lm.Network(*[x.astype(float) for x in net]) for _ in range(2)]
        moved[0][part][spot] += 1e-4
        moved[1][part][spot] -= 1e-4
        assert (loss(moved[0]) - loss(moved[1])) / 2e-4 == pytest.approx(slopes[part][spot], rel=2e-2, abs=1e-5)


def test_masked_query_learns(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = catalog.QUERIES["op3_masked_lm"](spark, folder).collect()
    assert len(got) == docs.count()
    words = masked_lm.count_words(docs)
    plain = docs.select(masked_lm.pseudo_likelihood("text", words, masked_lm.first_network()).alias("f")).select("f.*").collect()
    before, after = sum(r["log_likelihood"] for r in plain), sum(r["log_likelihood"] for r in got)
    assert after > before * 0.97
    odd = masked_lm.scored(odd_documents(spark)).collect()
    assert len(odd) == 14 and all((r["per_word"] is None) == (r["n_words"] == 0) for r in odd)
    assert masked_lm.scored(empty_documents(spark)).count() == 0


def test_words_that_share_a_slot_are_not_merged(spark):
    """The score is that of the slots, and of each word within its slot by its own count."""
    slots, together = masked_lm.SLOTS, {}
    for k in range(200_000):
        together.setdefault(zlib.crc32(f"word{k}".encode()) % slots, []).append(f"Word{k}")
    crowds = [names for names in together.values() if len(names) > 2][:40]
    draw = np.random.default_rng(4)
    names = [name for crowd in crowds for name in crowd] + ["é", "e\u0301", "alone"]
    texts = [" ".join(draw.choice(names, size)) for size in (400, 300, 5, 1)] + ["", None, "word0  WORD0"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(1, texts[1]), (None, texts[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    number = Counter(w for _, t in rows for w in (t or "").lower().split())
    slot = {w: zlib.crc32(w.encode()) % slots for w in number}
    total = Counter()
    for w, n in number.items():
        total[slot[w]] += n
    words = masked_lm.count_words(docs)
    net = masked_lm.train(docs, words)
    got = masked_lm.scored(docs).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(k) for k, _ in rows)
    slotted = docs.select("doc_id", masked_lm.pseudo_likelihood("text", words, net).alias("f"))
    plain = {r["doc_id"]: r["f"]["log_likelihood"] for r in slotted.collect()}
    for r in got:
        text = rows[2][1] if r["doc_id"] is None else texts[r["doc_id"]]
        inside = sum(math.log(number[w] / total[slot[w]]) for w in (text or "").lower().split())
        assert r["log_likelihood"] == pytest.approx(plain[r["doc_id"]] + inside, rel=1e-5, abs=1e-9)
        assert inside < -10 or r["n_words"] < 10
