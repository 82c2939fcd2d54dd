"""Problem 3: per-text quality statistics and a learned text type.

Statistics are Catalyst expressions.  Each threshold on them is a noisy labelling function
that votes for one type or abstains; expectation-maximization over the agreements of the
votes learns how far each function can be trusted, and every text gets the posterior of
each type.  Only the table of distinct vote patterns (bounded by the number of functions,
not by the data) reaches the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportloom.session import kept

TYPES = ("prose", "list", "table", "code", "filler", "garbled")

# The most frequent function words of languages that part words by blanks.
COMMON = {
    "en": "the a an of to in on at by for from with and or but is are was were be been has have not this that it as will since because after before",
    "fr": "le la les un une des du de et à au aux est sont pour par sur dans que qui ne pas",
    "de": "der die das und den dem des ein eine ist sind nicht mit auf für von zu noch",
    "es": "el la los las un una de del y en que por con para se es son no",
    "pt": "o os um uma do da em não com ao foi",
    "it": "il lo gli di che è sono per con non della",
    "nl": "de het een van en niet met op voor wordt",
    "id": "yang dan di untuk dengan dari tidak masih akan ini",
    "vi": "và của là các những trong cho với được không đã sẽ theo khi này có vì do sau vẫn",
    "ru": "и в на не что с со по для из от до при к за как это так его но или же уже после ввиду из-за",
    "pl": "i w na nie się z do jest że przez",
    "tr": "ve bir bu için ile da",
}
# Frequent words and particles of scripts without blanks: Thai, Japanese, Chinese.
PARTICLES = "การ ความ ที่ และ ใน ของ เพราะ จะ ให้ แล้ว เป็น ได้ ต้อง จาก ตาม อยู่ หลัง กว่า กำลัง ยัง ไม่ ว่า の は を が に で と た 的 了 在 是 和 将"
# What people type where nothing is to be said.
FILLER = r"n\.?/?\s?a\.?|tb[acds]|nil|none|null|ok|x+|-+|\.+|_+|\?+|empty|blank|to be (?:advised|confirmed|announced)"
SENTENCE_END = r"[.!?…。！？๏।](?:[\"'»”’)\]]*)(?:\s*\([^()\n]{4,20}\))?\s*$"

# Thai, Lao, Myanmar, Khmer, Kana and Han.
_UNSPACED = r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff"
_BEFORE, _AFTER = r"(?<![\p{L}\p{M}\p{N}/-])", r"(?![\p{L}\p{N}/]|-\p{N})"
_LETTER_WORD = rf"{_BEFORE}\p{{L}}[\p{{L}}\p{{M}}'’]*+(?:-\p{{L}}[\p{{L}}\p{{M}}]*+){{0,4}}{_AFTER}"
_CAPITAL_WORD = _LETTER_WORD.replace(r"\p{L}[", r"\p{Lu}[", 1)
_NUMBER = r"(?<!\S)\(?[-+−]?\d[\d.,]*+%?\)?[;,]?(?!\S)"
_CODE = r"(?<!\S)(?:[A-Z]{1,4}(?:-[A-Z0-9]{1,6}){2,8}+[;,]?|Rev\.?[A-Z0-9]{1,3}[;,]?)(?!\S)"
_LOWER_RUN = r"(?<!\S)(?:\p{Ll}[\p{Ll}\p{M}'’-]*+[,;:]?[^\S\n]++){3}\p{Ll}[\p{Ll}\p{M}'’-]"
# Consonants of the Latin and Cyrillic alphabets.
_CONSONANTS = "bcdfghjklmnpqrstvwxzçñßđбвгджзйклмнпрстфхцчшщъь"
_NO_VOWEL = rf"(?<![\p{{L}}\p{{M}}\p{{N}}/'’-])[{_CONSONANTS}{_CONSONANTS.upper()}][{_CONSONANTS}'’]{{1,40}}+{_AFTER}"
_MOJIBAKE = r"[Â-ô](?:[\u0080-¿]|[ŒœŠšŸŽžƒˆ˜–-›€™])|�"
_OPENING = r"(?<!\S)\p{Lu}\p{Ll}*+(?:[^\S\n]++\p{Ll}[\p{Ll}\p{M}'’-]*+[,;:]?){2}"
_BROKEN = r"\p{L}[^\p{L}\p{M}\p{N}\s'’./,:()&+\-\u200b-\u200d]+\p{L}\S*+"


def _share(n: Column, of: Column) -> Column:
    return F.when(of > 0, n / of).otherwise(F.lit(0.0))


def _count(xs: Column, cond) -> Column:
    return F.size(F.filter(xs, cond)).cast("double")


def _matches(t: Column, pattern: str) -> Column:
    return F.regexp_count(t, F.lit(pattern)).cast("double")


def _left(t: Column, pattern: str) -> Column:
    """How many characters are left without those of a pattern."""
    return F.length(F.regexp_replace(t, pattern, "")).cast("double")


def _measured(t: Column) -> dict[str, Column]:
    """What the statistics are made of: each pass over a text is made once."""
    common = sorted({w for ws in COMMON.values() for w in ws.split()})
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"\S"))
    pieces = F.filter(F.split(t, r"\n|\s[/|;,]\s|[;,|]\s"), lambda x: x.rlike(r"\S"))
    words = F.regexp_extract_all(t, F.lit(_LETTER_WORD), F.lit(0))
    # words in capitals are no function words, unless all of the text is
    lower = F.when(t.rlike(r"\p{Ll}"), words).otherwise(F.transform(words, F.lower))
    return {"_cased": F.when(t.rlike(r"\p{Ll}"), t).otherwise(F.lower(t)), "_lines": lines, "_pieces": pieces, "_words": words, "_common": _count(lower, lambda w: F.concat(F.lower(F.left(w, F.lit(1))), F.substring(w, 2, 1_000_000)).isin(common))}


def statistics(t: Column) -> dict[str, Column]:
    """Name -> expression over ``t``, the text with uniform line ends, and what _measured gives."""
    lines, pieces, n_words, n_lines = F.col("_lines"), F.col("_pieces"), F.size("_words").cast("double"), F.size("_lines").cast("double")
    n_tokens = _matches(t, r"(?U)\S++")
    visible = _left(t, r"(?U)\s+")
    script = t.rlike(f"[{_UNSPACED}]")
    unspaced = F.when(script, F.length(t).cast("double") - _left(t, f"[{_UNSPACED}]+")).otherwise(0.0)
    return {
        "n_chars": F.length(t).cast("double"),
        "n_words": n_tokens,
        "n_lines": n_lines,
        "mean_word_length": _share(F.length(F.array_join("_words", "")).cast("double"), n_words),
        "symbol_ratio": _share(_left(t, r"[\p{L}\p{M}\p{N}\s]+"), visible),
        "digit_ratio": _share(_left(t, r"\P{Nd}+"), visible),
        "end_share": _share(_count(lines, lambda x: x.rlike(SENTENCE_END)), n_lines),
        "common_share": _share(F.col("_common"), n_words),
        "n_common": F.col("_common"),
        "number_share": _share(_matches(t, _NUMBER), n_tokens),
        "code_share": _share(_matches(t, _CODE), n_tokens),
        "vowelless_share": _share(_matches(t, _NO_VOWEL), n_words),
        "mojibake_share": _share(2.0 * _matches(t, _MOJIBAKE), visible),
        "broken_share": _share(_matches(t, _BROKEN), n_tokens),
        "leader_share": _share(_count(lines, lambda x: x.rlike(r"(?<!\.)\.{4,}\s*\d+\s*$") | (x.rlike(r"(?:\.\s){4}") & x.rlike(r"[.\s]\d*\s*$"))), n_lines),
        "numbered_share": _share(_count(lines, lambda x: x.rlike(r"^\s*\d+(?:\.\d+)+\.?\s+\p{Lu}")), n_lines),
        "filler_share": F.greatest(
            _share(_count(pieces, lambda x: F.trim(x).rlike(rf"(?i)^(?:{FILLER})$")), F.size(pieces).cast("double")), _share(_matches(t, rf"(?i)(?<!\S)(?:{FILLER})(?!\S)"), n_tokens)
        ),
        "words_per_line": _share(n_words + unspaced / 4, n_lines),
        "capital_share": _share(_matches(F.col("_cased"), _CAPITAL_WORD), n_words),
        "unspaced_share": _share(unspaced, visible),
        "n_particles": F.when(script, _matches(t, "|".join(PARTICLES.split()))).otherwise(0.0),
        "lower_runs": _matches(F.col("_cased"), _LOWER_RUN),
        "openings": _matches(F.col("_cased"), _OPENING),
        "breaks": _matches(t, rf"\p{{Ll}}[.!?]\s+(?:\[[^\]\n]{{1,40}}\]\s)?\p{{Lu}}|[{_UNSPACED}]{{4}}[ 。][{_UNSPACED}]{{4}}"),
        "clauses": _matches(t, r"[\p{L}\p{N}³²],\s\p{Ll}"),
    }


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``df`` and one column per statistic.

    A null, empty or blank text has the counts 0 and the shares 0.0.
    """
    t = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"\r\n?", "\n")
    made = ("_t", "_cased", "_lines", "_pieces", "_words", "_common")
    base = df.withColumn("_t", t)
    return base.withColumns(_measured(F.col("_t"))).withColumns(statistics(F.col("_t"))).drop(*made)


def labelling_functions() -> dict[str, tuple[str, Column]]:
    """Name -> (type voted for, condition): one threshold on one statistic each.  Many are wrong for whole
    kinds of text (a list may have long lines, a remark no mark at its end); how far each is to be
    trusted is learned."""
    c = F.col
    return {
        "common_words": ("prose", (c("common_share") >= 0.1) | (c("n_particles") >= 1)),
        "lower_run": ("prose", (c("lower_runs") >= 1) | (c("unspaced_share") >= 0.3)),
        "opening": ("prose", (c("openings") >= 1) | (c("unspaced_share") >= 0.3)),
        "clause": ("prose", c("clauses") >= 1),
        "next_sentence": ("prose", c("breaks") >= 1),
        "end_mark": ("prose", c("end_share") > 0),
        "long_lines": ("prose", c("words_per_line") >= 5),
        "short_lines": ("list", (c("n_lines") >= 2) & (c("words_per_line") <= 4)),
        "leaders": ("list", c("leader_share") >= 0.5),
        "numbered": ("list", c("numbered_share") >= 0.5),
        "numbers": ("table", c("number_share") >= 0.25),
        "digits": ("table", c("digit_ratio") >= 0.25),
        "capitals": ("table", c("capital_share") >= 0.6),
        "codes": ("code", c("code_share") >= 0.3),
        "filler_words": ("filler", c("filler_share") >= 0.5),
        "mojibake": ("garbled", c("mojibake_share") >= 0.08),
        "symbols": ("garbled", c("symbol_ratio") >= 0.3),
        "broken_words": ("garbled", c("broken_share") >= 0.15),
        "no_vowels": ("garbled", c("vowelless_share") >= 0.3),
    }


def votes() -> Column:
    """The vote pattern as one integer: bit k set where function k votes."""
    bits = [F.when(cond, F.lit(1 << k)).otherwise(F.lit(0)) for k, (_, cond) in enumerate(labelling_functions().values())]
    out = bits[0]
    for b in bits[1:]:
        out = out + b
    return out.cast("int")


#: Texts that the start of the learning counts for, per type: a fixed number, so that what is learned
#: goes by the texts however many they are.
PSEUDO_TEXTS = 20.0
ROUNDS = 100


def learn(patterns: list[tuple[int, int]], rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expectation-maximization on (pattern, count): (prior of types, firing rates by
    function and type, posteriors by pattern).

    A function is described by how often it fires on each type; the start says that it
    fires mostly on the type it votes for, which also fixes the naming of the types.
    """
    lfs = list(labelling_functions().values())
    own = np.array([TYPES.index(t) for t, _ in lfs])
    bits = np.array([[p >> k & 1 for k in range(len(lfs))] for p, _ in patterns], float).reshape(-1, len(lfs))
    n = np.array([c for _, c in patterns], float)
    start = np.full((len(lfs), len(TYPES)), 0.04)
    start[np.arange(len(lfs)), own] = 0.6
    rate, prior = start.copy(), np.full(len(TYPES), 1 / len(TYPES))
    post = np.empty((len(patterns), len(TYPES)))
    for _ in range(rounds):
        log = np.log(prior) + bits @ np.log(rate) + (1 - bits) @ np.log(1 - rate)
        post = np.exp(log - log.max(1, keepdims=True))
        post /= post.sum(1, keepdims=True)
        mass = post * n[:, None]
        prior = (mass.sum(0) + 1) / (n.sum() + len(TYPES))
        rate = (bits.T @ mass + PSEUDO_TEXTS * start) / (mass.sum(0) + PSEUDO_TEXTS)
        rate = rate.clip(1e-4, 1 - 1e-4)
    return prior, rate, post


def _typed(voted: DataFrame) -> DataFrame:
    """``voted`` joined to what is learned from its column ``votes``."""
    rows = voted.where("votes is not null").groupBy("votes").count().collect()  # at most 2^functions, few in fact
    patterns = sorted((r["votes"], r["count"]) for r in rows)
    _, _, post = learn(patterns)
    table = [(p, *map(float, q), TYPES[int(np.argmax(q))]) for (p, _), q in zip(patterns, post, strict=True)]
    schema = "votes int, " + ", ".join(f"p_{t} double" for t in TYPES) + ", text_type string"
    return voted.join(F.broadcast(voted.sparkSession.createDataFrame(table, schema)), "votes", "left")


def with_votes(df: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``df``, the statistics, and ``votes`` (null for texts without a word)."""
    return with_statistics(df, text).withColumn("votes", F.when(F.col("n_words") > 0, votes()))


def classify(df: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``df``, the statistics, ``votes``, one ``p_<type>`` per type and
    ``text_type``, the type of greatest posterior (ties: the earlier in TYPES).

    Null, empty and blank texts are not learned from and get nulls for posteriors and type.
    An empty table gives an empty table.
    """
    return _typed(kept(with_votes(df, text)))


def long_texts(snapshots: DataFrame) -> DataFrame:
    """(snap_id, field, text) of both text fields of the snapshots, by one scan."""
    pair = lambda f: F.struct(F.lit(f).alias("field"), F.col(f).alias("text"))
    return snapshots.select("snap_id", F.explode(F.array(pair("first_concern"), pair("first_activity"))).alias("x")).select("snap_id", "x.field", "x.text")


def not_prose(snapshots: DataFrame) -> DataFrame:
    """(snap_id, field) of the non-empty texts whose type is not prose."""
    voted = with_votes(long_texts(snapshots)).select("snap_id", "field", "votes")
    return _typed(kept(voted)).where("text_type <> 'prose'").select("snap_id", "field")
