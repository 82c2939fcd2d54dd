"""The text operators against brute force, exact references and labelled cases."""

import random
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reportloom.llm import bpe, leakage, lookalike, quality
from reportloom.llm import queries as llm_queries


def docs(spark, *texts):
    return spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")


def rows(df):
    return set(map(tuple, df.collect()))


# --- problem 8 -------------------------------------------------------------------------------

SAME = [
    ("Scope A: 12 kW", "Ｓcοpе А: １２ kW"),
    ("café", "café"),
    ("line​ break", "line break"),
    ("one\r\ntwo", "one\ntwo"),
    ("trail  \nx ", "trail\nx"),
    ("71 kΩ µm 17 ℃ ﬁn", "71 kΩ μm 17 °C fin"),
    ("non‑breaking space　x", "non-breaking space x"),
    ("กำ", "กํา"),
    ("⚠️ note", "⚠ note"),
]
DIFFERENT = [("m²", "m2"), ("½", "1/2"), ("Work", "work"), ("cafe", "café"), ("l0", "lO"), ("don’t", "don't"), ("a b", "a  b"), ("a·b", "a•b"), ("👷‍🏗", "👷🏗"), ("a.", "a!")]


@pytest.mark.parametrize("a,b", SAME)
def test_same_look(a, b):
    assert lookalike.skeleton(a) == lookalike.skeleton(b)
    assert lookalike.skeleton(lookalike.skeleton(a)) == lookalike.skeleton(a)


@pytest.mark.parametrize("a,b", DIFFERENT)
def test_different_look(a, b):
    assert lookalike.skeleton(a) != lookalike.skeleton(b)


@pytest.mark.parametrize(
    "letters,plain",
    [
        ("\u04c0\u04cf\u0474\u0475\u04ae\u04af\u051a\u051b\u051c\u051d", "IlVvYyQqWw"),
        ("\u03f9\u03f2\u03f3\u037f", "CcjJ"),
        ("\u0585\u057d\u0555\u054d", "ouOU"),
        ("\u13aa\u13df\u13ac\u13bb\u13b7\u13a2", "ACEHMT"),
        ("\u0261\u0251\u0131", "gai"),
        ("\ua4ee\ua4d0\ua4f3", "ABO"),
        ("\u2c9e\u2c9f\u2ca4", "OoC"),
    ],
)
def test_rarer_letters_of_the_same_shape(letters, plain):
    assert lookalike.skeleton(letters) == lookalike.skeleton(plain) == plain


def test_pairs_equal_brute_force(spark):
    rng = random.Random(4)
    swaps = {"a": "а", "e": "е", "o": "ο", " ": " ", "p": "р"}
    base = ["no change at the gate", "a piece of rope", "pour done", "\t \n", "", None]
    texts = []
    for _ in range(150):
        t = rng.choice(base)
        if t and rng.random() < 0.3:
            t = "".join(swaps.get(c, c) if rng.random() < 0.2 else c for c in t)
        texts.append(t)
    df = docs(spark, *texts)
    look = [lookalike.skeleton(t) for t in texts]
    rep = {}
    for k, t in enumerate(texts):
        rep.setdefault(t, k)
    want = set()
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            if i < j and look[i] and look[i] == look[j] and a != b and (rep[a] == i or rep[b] == j):
                want.add((i, j))
    got = rows(lookalike.lookalike_pairs(df))
    assert got == want and want
    # every pair of which one text is unique is there
    unique = {t for t in texts if texts.count(t) == 1}
    assert {(i, j) for i in range(150) for j in range(i + 1, 150) if look[i] and look[i] == look[j] and texts[i] != texts[j] and {texts[i], texts[j]} & unique} <= got
    cls = {r.doc_id: (r.class_id, r.n_spellings, r.n_documents) for r in lookalike.lookalike_classes(df).collect()}
    for k, s in enumerate(look):
        if s:
            own = [j for j, x in enumerate(look) if x == s]
            assert cls[k] == (own[0], len({texts[j] for j in own}), len(own))
        else:
            assert k not in cls


def test_hot_copies(spark):
    """A third of all rows are one text: the pairs grow with the rows, not with their square."""
    df = docs(spark, *["same old text"] * 400, *[f"text no {k}" for k in range(800)], "sаme old text")
    got = rows(lookalike.lookalike_pairs(df))
    assert got == {(k, 1200) for k in range(400)}


def test_many_spellings_of_one_look(spark):
    """k spellings give k - 1 pairs of representatives, and one class."""
    zero = ["\u200b", "\u200c", "\u2060", "\ufeff"]
    texts = [f"on{zero[k % 4]}e{zero[k // 4 % 4]} lo{zero[k // 16 % 4]}ok{zero[k // 64 % 4]}{zero[k // 256]}" for k in range(400)]
    df = docs(spark, *texts, "another look")
    assert rows(lookalike.class_pairs(df)) == {(0, k) for k in range(1, 400)}
    assert {(r.doc_id, r.class_id, r.n_spellings) for r in lookalike.lookalike_classes(df).collect()} == {*((k, 0, 400) for k in range(400)), (400, 400, 1)}


PLAIN = ["a  \nb", "a \t \r\nb\r", "\r\r\n a\n\n", " ", "", "x" * 9, "a\tb \n", "\n \n", None, "a \x0b b", "é  \r\n", " " * 50_000 + "x" + " " * 50_000 + "\ny"]


def test_plain_texts_have_the_same_form(spark):
    """The expression for plain texts and the function agree."""
    got = {r.doc_id: r.s for r in docs(spark, *PLAIN).select("doc_id", lookalike.skeleton_of(F.col("text")).alias("s")).collect()}
    assert got == {k: lookalike.skeleton(t) for k, t in enumerate(PLAIN)}


def test_batches_equal_single_texts(spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    rng = random.Random(7)
    texts += ["".join(chr(rng.choice((rng.randrange(32, 0x250), rng.randrange(0x300, 0x600), rng.randrange(0x1D00, 0x3000), rng.randrange(0xFB00, 0xFE10), rng.randrange(0x1F000, 0x1FAFF), 10, 13, 0x200D))) for _ in range(60)) for _ in range(400)]
    texts += ["a\ufdd0b \n", "", None, "\ufdd0"]
    assert lookalike.skeletons(texts) == [lookalike.skeleton(t) for t in texts]
    assert lookalike.skeletons([t for t in texts if t is None or "\ufdd0" not in t]) == [lookalike.skeleton(t) for t in texts if t is None or "\ufdd0" not in t]
    assert lookalike.skeletons([]) == []


# --- problem 6 -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda s: t.encode(s or "", add_special_tokens=False).ids


ODD = ["", None, " ", "\n\n\n x", "a" * 3000, " " * 500 + "b", "<|endoftext|>", "it's we'LL 12,5kW!!", "งานเทคอนกรีต", "👷‍🏗️", "\u0000�", "Ünïcödé ＡＢＣ"]


def test_token_ids(spark, sf, reference):
    for t in ODD:
        flat, _ = bpe.encoder().encode([t])
        assert flat.tolist() == reference(t)
    src = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r.ids for r in bpe.token_ids(src).collect()}
    texts = {r.doc_id: r.text for r in src.collect()}
    assert got == {k: reference(t) for k, t in texts.items()}
    df = docs(spark, *ODD).withColumn("ids", F.lit(1)).withColumn("key_", F.lit(2))
    assert [r.ids for r in bpe.token_ids(df).orderBy("doc_id").collect()] == [reference(t) for t in ODD]
    n = bpe.token_counts(df.withColumn("half", F.col("doc_id") % 2), "half").collect()
    assert {(r.half, r.n_documents, r.n_tokens) for r in n} == {(h, 6, sum(len(reference(t)) for t in ODD[h::2])) for h in (0, 1)}


def test_merges_equal_plain_merging():
    ranks = bpe.encoder().ranks

    def plain(piece):
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min(((ranks.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
            if best[0] == 1 << 30:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [ranks[p] for p in parts]

    rng = random.Random(2)
    for _ in range(300):
        piece = bytes(rng.choice(b"aetn oisr\xe0\xb8\x81\xff") for _ in range(rng.randint(1, 40)))
        assert bpe.merge(piece, ranks) == plain(piece)


def test_perfect_hash():
    keys = [f"k{i}".encode() for i in range(2000)]
    h = bpe.PerfectHash(keys, list(range(2000)))
    assert h.lookup(keys) == list(range(2000)) and sorted(h.keys) == sorted(keys)
    assert set(h.lookup([b"x%d" % i for i in range(500)])) == {-1}


# --- problem 7 -------------------------------------------------------------------------------


def _texts(spark):
    rng = random.Random(9)
    vocabulary = [f"w{k}" for k in range(400)]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [say(60) for _ in range(12)]
    around = lambda inner: " ".join([*say(30), *inner, *say(30)])
    cases, want = [], set()

    def add(text, item=None):
        if item is not None:
            want.add((len(cases), item))
        cases.append(text)

    add(around(items[0]), 0)
    add(around([w.upper() for w in items[1]]).replace(" ", ",\n"), 1)
    add(around([w if k % 9 else "other" for k, w in enumerate(items[2])]), 2)  # every ninth word replaced
    add(around(items[3][20:42]), 3)  # 22 of 60 words
    add(around(items[4][:12]) + " " + around(items[4][40:52]), 4)  # two pieces of 12
    add(around(items[5]).replace("w", "ｗ").replace("1", "１"), 5)
    add(around(items[6][:15]))  # a quarter
    add(around(items[7][:9]))  # short quotation
    add(around([]))
    add(around(items[8]) + " " + around(items[9]), 8)
    want.add((len(cases) - 1, 9))
    add(around([w[:1] + "\u200d\u200b" + w[1:] + "\u0301" for w in items[10]]), 10)  # characters without width inside the words
    cases += [None, "", " "]
    d = docs(spark, *cases)
    i = spark.createDataFrame([(k, "s", " ".join(w)) for k, w in enumerate(items)] + [(99, "s", None), (98, "s", ""), (97, None, "w1 w2 w3")], "item_id bigint, suite string, text string")
    return d, i, want


def test_leaks(spark):
    d, i, want = _texts(spark)
    for df in (d, d.unionByName(d), d.withColumn("item_id", F.lit(7)).withColumn("seed", F.lit(1))):
        assert rows(leakage.leaked_items(df, i).select("doc_id", "item_id")) == want
    shared = {r.doc_id: r.share for r in leakage.leaked_items(d, i).collect()}
    assert shared[0] == 1.0 and shared[3] == pytest.approx(22 / 60)


def test_leaks_by_blocks(spark):
    """Item sets larger than a block are searched block by block, with the same rows."""
    d, i, want = _texts(spark)
    one, many = (rows(leakage.leaked_items(d, i, block_chars=n)) for n in (1 << 30, 300))
    assert one == many and {x[:2] for x in one} == want


def _paired(item, *texts):
    """(paired words, item words) of every text, whatever its share."""
    index = leakage.ItemIndex([1], [item])
    v, offsets = index.numbered(pa.array(list(texts), pa.string()))
    got = {t: (n, of) for t, _, n, of, _ in leakage.leaked(index, v, offsets, 0, 1)}
    return [got.get(t, (0, len(index.words[0]))) for t in range(len(texts))]


def test_seeds_tolerate_a_substitution():
    item = [f"w{k}" for k in range(20)]
    texts = [" ".join([*item[:at], "changed", *item[at + 1 :]]) for at in range(20)]
    assert all(n >= 17 for n, _ in _paired(" ".join(item), *texts))


def test_words_are_paired_once():
    """Copies of a phrase that an item repeats add up; one copy counts once."""
    phrase = " ".join(f"p{k}" for k in range(12))
    copies = " ".join(f"{phrase} z{k} y{k} q{k}" for k in range(21))
    assert _paired(" ".join([phrase] * 60), copies, f"aa bb {phrase} cc dd") == [(252, 720), (12, 720)]
    assert _paired(" ".join([phrase] * 20), f"aa bb {phrase} cc dd") == [(12, 240)]
    assert _paired("x " * 3000, "x " * 3000, "x " * 1000) == [(3000, 3000), (1000, 3000)]


def test_pairs_are_as_many_as_can_be():
    """Against plain augmentation over all cells of all pieces of all diagonals."""
    rng = random.Random(11)
    for _ in range(300):
        words = "abcdef"[: rng.randint(2, 6)]
        phrases = [[rng.choice(words) for _ in range(rng.randint(5, 14))] for _ in range(3)]
        make = lambda n: [w for _ in range(n) for w in (rng.choice(phrases) if rng.random() < 0.8 else [rng.choice("uvxyz")])]  # noqa: E731, B023
        item, doc = make(rng.randint(2, 6)), make(rng.randint(2, 8))
        index = leakage.ItemIndex([1], [" ".join(item)])
        v, offsets = index.numbered(pa.array([" ".join(doc)]))
        a, b = v.tolist(), index.words[0]
        cells = {}
        for d in range(-len(b), len(a)):
            done = -1
            for i in range(max(0, -d), min(len(b), len(a) - d)):
                fits = lambda m: all(i + k < len(b) and i + d + k < len(a) and b[i + k] == a[i + d + k] for k, c in enumerate(m) if c == "1")  # noqa: E731, B023
                if i > done and any(map(fits, leakage.MASKS)):
                    lo, done = leakage._reach(a, b, d, i, -1), leakage._reach(a, b, d, i, 1)
                    if done - lo + 1 >= leakage.MIN_PIECE:
                        for k in range(lo, done + 1):
                            cells.setdefault(k, set()).add(k + d)
        mate = {}

        def free(i, seen):
            for j in cells[i]:
                if j in seen:
                    continue
                seen.add(j)
                if j not in mate or free(mate[j], seen):
                    mate[j] = i
                    return True
            return False

        want = sum(free(i, set()) for i in cells)
        assert _paired(" ".join(item), " ".join(doc))[0][0] == want, (item, doc)


def test_recall_over_substitutions():
    """Items with a share of their words replaced at random: found while a few words differ."""
    rng = random.Random(3)
    vocabulary = [f"v{k}" for k in range(2000)]
    items = [[rng.choice(vocabulary) for _ in range(90)] for _ in range(60)]
    found = {}
    for rate in (0.05, 0.1, 0.15, 0.2):
        hit = 0
        for item in items:
            text = " ".join(w if rng.random() >= rate else "other" for w in item)
            hit += _paired(" ".join(item), f"before {text} after")[0][0] * 3 >= len(item)
        found[rate] = hit / len(items)
    assert found[0.05] == found[0.1] == 1.0 and found[0.15] > 0.95 and found[0.2] > 0.75, found


# --- problem 3 -------------------------------------------------------------------------------

PROSE = [
    "Concrete pour at the north pier was completed on Friday.", "The crane is still waiting for a permit", "3. Poor weather at the quay and around the gate (12 Aug 2026)",
    "[Yard (AB)] So far 91.5 of 1,250 panels\nare in place at row 3.", "Les travaux de peinture sont terminés et la réception est prévue lundi.", "Khối lượng 29 m³, móng trụ số năm vẫn chưa nghiệm thu.",
    "Площадка складирования ожидает поставки после замены чертежей.", "ทีมสำรวจจะวัดระดับอีกครั้ง เพราะรถเครนชำรุด", "NO CHANGE AT THE JETTY THIS WEEK", "The naïve forecast was kept; 12.5 % of 40 m² is done.",
    "Der Kran wartet noch auf die Genehmigung der Behörde", "La grúa sigue a la espera del permiso municipal", "Pekerjaan pengecoran masih menunggu izin dari pemilik", "クレーンはまだ許可を待っています。", "Kreni bado inasubiri kibali kutoka kwa mamlaka ya mji", "Nosturi odottaa edelleen lupaa kaupungilta, työ jatkuu maanantaina.",
]
NOT_PROSE = [
    "roof truss\n- oil pit\n• pipe rack\ncable tray", "Oil Pit ............ 61\nRoof Truss .......... 20", "Qty Remark Total Unit\nPipe Rack 80.96 8.99 78.94\nOil Pit 1.00 25.16 27.98",
    "897.0% (377) 362.00 (171) (173)\n12 5 7", "IN-085-M-087 Rev.1 ; EL-083-E-058 Rev.A ; HS-075-C-246 Rev.0", "N/A\nN/A\nN/A", "TBA / TBA / TBA / TBA", "xx xx xx xx", "5.7 Outgoing Letters\n4.1 Root Cause Register\n7.2 SHE Status",
    "qdh wlhpqx bl bqg nbxtb jsxgt czjcg", ";l|Il]>~{>{~lnlIr.Ir[+<|O,|_l;[:+Or0rI:¦I", "à¸\x87à¸²à¸\x99à¸\x81à¸³à¹\x81à¸\x9eà¸\x87à¸\x81à¸±à¸\x99", "24 PRO [HS.] Slope Drain 5-Aug-26 18-Aug-26 -8\n22 COM [MC.] Blade Root 2-Aug-26 5-Sep-26 20",
]


def test_text_types(spark):
    """The cases among the texts of a table: what is learned comes from all of them."""
    texts = PROSE * 3 + NOT_PROSE
    table = quality.long_texts(spark.read.parquet("/root/testdata/sf0.01/w32_2026.parquet")).select((-F.col("snap_id") - 1).alias("doc_id"), "text")
    df = docs(spark, *texts, None, "", " \n\t ").unionByName(table)
    got = {r.doc_id: r for r in quality.classify(df).collect()}
    for k, t in enumerate(texts):
        assert (got[k].text_type == "prose") is (t in PROSE), (t, got[k].text_type)
        assert sum(got[k][f"p_{x}"] for x in quality.TYPES) == pytest.approx(1)
    for k in range(len(texts), len(texts) + 3):
        assert got[k].text_type is None and got[k].n_words == 0 and got[k].common_share == 0.0


def test_statistics(spark):
    r = quality.with_statistics(docs(spark, "The crane is here.\r\nTwo of 4 done")).first()
    assert (r.n_words, r.n_lines, r.end_share, r.number_share) == (8.0, 2.0, 0.5, 0.125)
    assert r.mean_word_length == pytest.approx(23 / 7)
    assert r.common_share == pytest.approx(3 / 7)
    long = "word " * 200_000
    assert quality.with_statistics(docs(spark, long)).first().n_words == 200_000


def _planted(spoil=None):
    """(patterns, truth by pattern): drawn texts of four types; a spoilt function fires at random."""
    names = list(quality.labelling_functions())
    own = [t for t, _ in quality.labelling_functions().values()]
    rng = np.random.default_rng(0)
    texts = {}
    for _ in range(6000):
        kind = ("prose", "list", "table", "garbled")[rng.choice(4, p=(0.6, 0.15, 0.15, 0.1))]
        fire = [k for k, t in enumerate(own) if rng.random() < (0.5 if t == kind else 0.08)]
        if spoil:
            fire = [k for k in fire if names[k] != spoil] + ([names.index(spoil)] if rng.random() < 0.5 else [])
        p = sum(1 << k for k in set(fire))
        n = texts.setdefault(p, [0, 0])
        n[kind == "prose"] += 1
    return names, {p: sum(n) for p, n in texts.items()}, texts


def _errors(texts, prose):
    return sum(n[0] if prose(p) else n[1] for p, n in texts.items())


def test_learning_finds_a_poor_function():
    """A function that fires at random is trusted less than those that agree, and the posteriors are right
    where votes by number, or the start, are not."""
    names, patterns, texts = _planted(spoil="symbols")
    pats = sorted(patterns.items())
    at = quality.TYPES.index
    prior, rate, post = quality.learn(pats)
    assert rate[names.index("common_words"), at("prose")] > 0.4 > 0.2 > rate[names.index("common_words"), at("list")]
    assert abs(rate[names.index("symbols"), at("prose")] - rate[names.index("symbols"), at("list")]) < 0.1
    assert prior[at("prose")] == pytest.approx(0.6, abs=0.05)
    learned = {p: q[0] == q.max() for (p, _), q in zip(pats, post, strict=True)}
    started = {p: q[0] == q.max() for (p, _), q in zip(pats, quality.learn(pats, 1)[2], strict=True)}
    prose_bits = sum(1 << k for k, (t, _) in enumerate(quality.labelling_functions().values()) if t == "prose")
    any_prose = lambda p: p & prose_bits > 0
    majority = lambda p: (p & prose_bits).bit_count() > (p & ~prose_bits).bit_count()
    wrong = _errors(texts, learned.get)
    assert wrong < 0.1 * 6000 and wrong < 0.9 * _errors(texts, started.get) and wrong < 0.5 * _errors(texts, any_prose) and wrong < 0.8 * _errors(texts, majority)


def test_learning_decides_the_rows(spark):
    """On the tables the learned posteriors, the start and simple votes give different rows."""
    w = spark.read.parquet("/root/testdata/sf0.01/w32_2026.parquet")
    voted = quality.with_votes(quality.long_texts(w)).where("votes is not null").groupBy("votes").count().collect()
    pats = sorted((r["votes"], r["count"]) for r in voted)
    n = np.array([c for _, c in pats])
    bits = [(1 << k, t == "prose") for k, (t, _) in enumerate(quality.labelling_functions().values())]
    prose = lambda post: post.argmax(1) == 0
    learned, started = prose(quality.learn(pats)[2]), prose(quality.learn(pats, 1)[2])
    any_prose = np.array([any(p & b for b, own in bits if own) for p, _ in pats])
    majority = np.array([sum(1 if own else -1 for b, own in bits if p & b) > 0 for p, _ in pats])
    for other in (started, any_prose, majority):
        assert n[learned != other].sum() > 5


# --- all -------------------------------------------------------------------------------------


def test_queries_on_the_smallest_tables(spark, sf):
    for name, q in llm_queries.queries().items():
        assert q(spark, sf).count() > 0, name


def test_queries_on_empty_tables(spark, sf, tmp_path):
    for t in ("documents", "eval_items", "w32_2026"):
        spark.read.parquet(f"{sf}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    for name, q in llm_queries.queries().items():
        assert q(spark, str(tmp_path)).count() == 0, name


def test_extra_columns_with_clashing_names(spark, sf):
    w = spark.read.parquet(f"{sf}/w32_2026.parquet")
    want = rows(quality.not_prose(w))
    for name in ("votes", "_t", "_lines", "n_words", "text", "field", "text_type", "x"):
        w = w.withColumn(name, F.lit("clash"))
    assert rows(quality.not_prose(w)) == want
    d = spark.read.parquet(f"{sf}/documents.parquet")
    pairs = rows(lookalike.lookalike_pairs(d))
    for name in ("sk", "cls", "spell", "rep", "n", "rep_2", "skeleton"):
        d = d.withColumn(name, F.lit("clash"))
    assert rows(lookalike.lookalike_pairs(d)) == pairs


def test_forms_are_normal(spark, sf):
    for r in lookalike.with_skeleton(spark.read.parquet(f"{sf}/documents.parquet")).select("text", "skeleton").collect():
        assert (r.text is None) is (r.skeleton is None)
        assert r.skeleton is None or unicodedata.is_normalized("NFD", r.skeleton)


LONG = ["x " * 300_000, " " * 300_000 + "x" + " " * 300_000, "." * 200_000, ". " * 200_000, "a-" * 200_000, "\n" * 200_000 + "end", "é" * 300_000, "Ａ " * 100_000, "7 " * 200_000, "(" * 200_000]


def test_very_long_texts(spark):
    """No operator falls over, or becomes quadratic, on very long texts of one kind."""
    df = docs(spark, *LONG)
    assert quality.classify(df).where("text_type is not null").count() == len(LONG)
    assert len(lookalike.lookalike_classes(df).collect()) == len(LONG)
    assert leakage.leaked_items(df, docs(spark, *LONG[:2]).withColumnRenamed("doc_id", "item_id")).where("doc_id = 0").count() == 1
    assert bpe.token_ids(df).where("size(ids) > 0").count() == len(LONG)
