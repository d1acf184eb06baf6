"""Linking noisy text to the plan dimension: subjects, file names, document text, payers."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docroute.functions import text as t
from docroute.operators import dimension
from docroute.session import checkpointed, stored

EXACT, SUFFIX_DROPPED, SHARED_MANAGER, BY_NAME = 10, 9, 7, 6  # fixed scoring weights
LEAD = 3
NAME_WORD, NAME_CAP, NAME_MIN = 3, 12, 6
GRAM, DIGITS = 4, 5  # fixed: shortest name word, most digits of a code


# ---- subjects and bodies

def subject_tokens(c) -> Column:
    """Plan-like tokens in order of first appearance."""
    raw = F.regexp_extract_all(F.upper(t.blank(c)), F.lit(t.SUBJECT_CODE), F.lit(0))
    return F.array_distinct(F.transform(raw, lambda m: F.regexp_replace(m, r"(?U)[\s\-#:/_]", "")))


def _numbered(src: int):
    return lambda x, i: F.struct(F.lit(src).alias("src"), i.cast("long").alias("pos"), x.alias("token"))


def token_ladder() -> Column:
    """Subject tokens, then body tokens, each with its source and position."""
    return F.flatten(F.array(*[F.transform(subject_tokens(F.col(c)), _numbered(src)) for src, c in enumerate(("subject", "body_preview"))]))


def link_messages(messages: DataFrame, plans: DataFrame) -> DataFrame:
    """The first known token, subject before body, with the plan row it names.

    Both ladders are one exploded column ordered by (source, position), so the dimension is joined once and
    only matching tokens are shuffled.
    """
    tokens = messages.select("msg_id", F.inline(token_ladder()))
    known = dimension.first_manager(plans).select(F.col("plan_norm").alias("token"), "manager_name", "manager_email")
    best = (
        tokens.join(known, "token")
        .groupBy("msg_id")
        .agg(F.min(F.struct("src", "pos", "token", "manager_name", "manager_email")).alias("m"))
        .select("msg_id", F.col("m.token").alias("plan_norm"), "m.manager_name", "m.manager_email", F.when(F.col("m.src") == 0, "subject").otherwise("body").alias("match_source"))
    )
    return messages.join(best, "msg_id", "left").withColumns(
        {c: t.blank(c) for c in ("plan_norm", "manager_name", "manager_email", "match_source")}
    )


# ---- file names

def name_fallback_index(plans: DataFrame) -> DataFrame:
    """Every code a file name may carry -> the row it routes to.

    Plans are exploded to their 1-, 2- and 3-letter-stripped bases, which turns "name plus 1-3 letters" into an
    equi-join; a base is usable when all its variants share one manager.
    """
    active = plans.where("status_active and manager_name <> ''")
    exact = active.groupBy(F.col("plan_norm").alias("code")).agg(
        F.min_by(F.struct("plan_norm", "manager_name", "manager_key", "manager_email", "strata_name"), "row_no").alias("r"), F.lit(False).alias("is_base")
    )
    n = F.length("plan_norm")
    bases = F.filter(
        F.transform(F.sequence(F.lit(1), F.lit(3)), lambda k: F.when(
            (n > k) & F.substring(F.col("plan_norm"), n - k + 1, k).rlike("^[A-Z]+$"), F.substring(F.col("plan_norm"), F.lit(1), n - k))),
        lambda b: b.isNotNull(),
    )
    base = (
        active.select("row_no", "manager_name", "manager_key", "manager_email", "strata_name", F.explode(bases).alias("code"))
        .groupBy("code")
        .agg(
            F.min("manager_name").alias("lo"), F.max("manager_name").alias("hi"),
            F.min_by(F.struct(F.col("code").alias("plan_norm"), "manager_name", "manager_key", "manager_email", "strata_name"), "row_no").alias("r"),
        )
        .where("lo = hi")
        .select("code", "r", F.lit(True).alias("is_base"))
    )
    both = exact.select("code", "r", "is_base").unionByName(base)
    return both.groupBy("code").agg(F.min_by("r", "is_base").alias("r"), F.min("is_base").alias("is_base"))


def link_file_names(files: DataFrame, plans: DataFrame, name_col: str = "name") -> DataFrame:
    """Adds name_plan (as written), exact_plan (J3) and fallback_*."""
    idx = name_fallback_index(plans).select(
        F.col("code").alias("name_plan"), F.col("r.plan_norm").alias("fallback_plan"), F.col("r.manager_name").alias("fallback_manager"),
        F.col("r.manager_email").alias("fallback_email"), F.col("is_base").alias("fallback_is_base"),
    )
    # A code that is no base is a plan's own; names without a code are one frequent key, which a join with a written table can split.
    idx = stored(idx.withColumn("exact_plan", F.when(~F.col("fallback_is_base") & (F.col("name_plan") != ""), F.col("name_plan"))))
    out = files.withColumn("name_plan", t.plan_from_name(F.col(name_col))).join(idx, "name_plan", "left")
    return out.withColumns({
        **{c: t.blank(c) for c in ("exact_plan", "fallback_plan", "fallback_manager", "fallback_email")},
        "fallback_is_base": F.coalesce("fallback_is_base", F.lit(False)),
    })


def resolve_payer(files: DataFrame, plans: DataFrame, name_col: str = "file_name") -> DataFrame:
    """Plan in the file name -> payer, else a base whose variants agree on payer and e-mail."""
    exact = dimension.first_payer(plans).select(F.col("plan_norm").alias("name_plan"), F.struct("plan_norm", "ap_name", "ap_key", "ap_email").alias("by_plan"))
    base = dimension.base_index(plans).where("payer_row is not null and payer_lo = payer_hi").select(F.col("base").alias("name_plan"), F.col("payer_row").alias("by_base"))
    out = files.withColumn("name_plan", t.plan_from_name(F.col(name_col))).join(exact, "name_plan", "left").join(base, "name_plan", "left")
    r = F.coalesce("by_plan", "by_base")
    return out.withColumns({
        "payer": t.blank(r["ap_name"]), "payer_key": t.blank(r["ap_key"]), "payer_email": t.blank(r["ap_email"]),
        "payer_source": F.when(F.col("name_plan") == "", "no plan in name").when(F.col("by_plan").isNotNull(), "plan").when(F.col("by_base").isNotNull(), "base").otherwise("no payer"),
    }).drop("by_plan", "by_base")


# ---- document text

def list_pattern(plans: DataFrame) -> Column:
    """The code pattern restricted to the list's own prefixes, longest first, as one scalar subquery.

    Prefixes are nested by their first and second letter, so a place in a text is held against a few dozen letters and
    the endings of one pair, however long the list is.
    """
    p = dimension.coded(plans).select("prefix").distinct()
    ending = F.struct((-F.length("prefix")).alias("k"), F.substring("prefix", 3, 6).alias("rest"))
    pairs = p.groupBy(F.substring("prefix", 1, 1).alias("a"), F.substring("prefix", 2, 1).alias("b")).agg(F.array_sort(F.collect_list(ending)).alias("ends"))
    pairs = pairs.select("a", F.concat("b", F.lit("(?:"), F.array_join("ends.rest", "|"), F.lit(")")).alias("tail"))
    first = pairs.groupBy("a").agg(F.array_sort(F.collect_list("tail")).alias("tails"))
    first = first.select(F.concat("a", F.lit("(?:"), F.array_join("tails", "|"), F.lit(")")).alias("branch"))
    alt = F.when(F.count("*") == 0, F.lit(t.ANY_PREFIX)).otherwise(F.array_join(F.array_sort(F.collect_list("branch")), "|"))
    return first.agg(F.concat(F.lit(t.LIST_CODE_HEAD + "("), alt, F.lit(")" + t.CODE_TAIL)).alias("pattern")).scalar()


def matchable(c) -> Column:
    return F.translate(F.upper(t.blank(c)), "№＃", "##")


def explicit_tokens(c) -> Column:
    """Tokens the text itself labels as a plan, in order of first appearance."""
    raw = F.regexp_extract_all(F.upper(t.blank(c)), F.lit(t.LABELLED_CODE), F.lit(0))
    return F.array_distinct(F.transform(raw, lambda m: F.regexp_replace(m, t.LABELLED_CODE, "$1$2$3")))


#: The fields of `scan_texts` that linking a text to a plan reads.
LINKED = ["is_blank", "codes", "explicit", "words"]


def _findings(docs: DataFrame, plans: DataFrame, text: str, only: list[str] | None) -> tuple[DataFrame, Column]:
    """`docs` with the list's pattern, and the fields that one pass over each text gives."""
    docs = docs.withColumn("_pat", list_pattern(plans))
    short = F.transform(F.regexp_extract_all(matchable(F.col(text)), F.col("_pat"), F.lit(0)), lambda m: F.regexp_replace(m, F.col("_pat"), F.lit("$1|$2|$3")))
    words = F.regexp_extract_all(matchable(F.col(text)), F.lit(r"(?U)\w+"), F.lit(0))
    digitless = _digitless(plans)
    found = {
        "is_blank": t.strip(F.col(text)) == "",
        "codes": short,
        "explicit": explicit_tokens(F.col(text)),
        "invoice_number": t.invoice_number(F.col(text)),
        "amount_cents": t.amount_cents(F.col(text)),
        "words": F.when(digitless > 0, F.filter(words, lambda w: ~w.rlike(r"(?U)\d"))).otherwise(F.array().cast("array<string>")),
    }
    return docs, F.struct(*[c.alias(name) for name, c in found.items() if only is None or name in only])


def scan_texts(docs: DataFrame, plans: DataFrame, key: str = "sha256", text: str = "content_text", only: list[str] | None = None) -> DataFrame:
    """One pass over each text: every field later operators need, so the text itself is never shuffled.

    Copies of one text collapse here: rows are combined per content key before and after the shuffle. The
    fields are written once, so however many operators follow, no text is read or matched a second time. `only`: the
    fields that they read, all by default; as they are written, Spark cannot leave out the others by itself.
    """
    docs, f = _findings(docs, plans, text, only)
    return stored(docs.select(key, f.alias("f")).groupBy(key).agg(F.any_value("f").alias("f")).select(key, "f.*"))


def _digest(c: Column) -> Column:
    """128 bits of the SHA-256 of a text."""
    return F.substring(F.unhex(F.sha2(c, 256)), 1, 16)


def scan_rows(docs: DataFrame, plans: DataFrame, text: str = "content_text") -> DataFrame:
    """The rows with `content` (a key of the text), `f` (LINKED, one pass over the text) and `found` (a key of `f`); a null text has no keys.

    Nothing is shuffled: most texts stand in one row, and only their findings are combined, in `match_rows`.
    """
    docs, f = _findings(docs, plans, text, LINKED)
    docs = docs.withColumns({"f": f, "content": _digest(F.col(text))}).drop("_pat")
    return docs.withColumn("found", F.when(F.col("content").isNotNull(), _digest(F.to_json("f"))))


def _digitless(plans: DataFrame) -> Column:
    return plans.where(F.col("status_active") & ~F.col("plan_norm").rlike(r"(?U)\d")).agg(F.count("*")).scalar()


def text_tokens(scanned: DataFrame, plans: DataFrame, key: str = "sha256") -> DataFrame:
    """A4: (document, token, count, first position), codes with digits and whole-word codes without."""
    codes = scanned.select(key, F.posexplode("codes")).select(key, F.col("pos").cast("long").alias("pos"), F.split("col", r"\|").alias("p"))
    coded = codes.select(key, "pos", F.array_join("p", "").alias("token"), F.col("p")[1].alias("num"))
    plain = plans.where(F.col("status_active") & F.col("plan_norm").rlike(r"(?U)^[\w&&[^\d]]+$")).groupBy(F.col("plan_norm").alias("token")).agg(F.min("row_no").alias("row_no"))
    named = scanned.select(key, F.explode("words").alias("token")).join(plain, "token").select(key, (F.col("row_no") + (1 << 40)).alias("pos"), "token", F.lit("").alias("num"))
    return coded.unionByName(named).groupBy(key, "token", "num").agg(F.count("*").alias("cnt"), F.min("pos").alias("pos"))


def _code_index(plans: DataFrame) -> DataFrame:
    """code -> the first row with that code, and whether it is a base whose variants share one manager."""
    active = plans.where("status_active")
    row = F.struct("plan_norm", "manager_name", "manager_key", "manager_email", "strata_name")
    usable = active.where(F.col("plan_norm").rlike(dimension.CODE_PARTS) | ~F.col("plan_norm").rlike(r"(?U)\d"))
    own = usable.groupBy(F.col("plan_norm").alias("code")).agg(F.min_by(row, "row_no").alias("own_row"))
    rows = dimension.coded(plans)
    firsts = own.select(F.col("code").alias("plan_norm"), "own_row")
    variant = rows.groupBy("base").agg(F.min_by("plan_norm", "row_no").alias("plan_norm")).join(firsts, "plan_norm").select(F.col("base").alias("code"), F.col("own_row").alias("variant_row"))
    shared = dimension.base_unique_manager(plans).select(F.col("base").alias("code"), F.lit(True).alias("shared"))
    return own.join(variant, "code", "full_outer").join(shared, "code", "left")


def _parts(number: Column, shorter: bool = False) -> Column:
    """Every run of digits inside a number, up to the length a number can have."""
    n = F.length(number)
    most = lambda i: F.least(F.lit(DIGITS), n - i + 1)
    parts = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(F.lit(1), most(i)), lambda k: F.substring(number, i, k))))
    return F.array_distinct(F.filter(parts, lambda x: F.length(x) < n) if shorter else parts)


def _long_words(text: Column) -> Column:
    return F.filter(F.split(text, "[^A-Z0-9]+"), lambda w: F.length(w) >= GRAM)


def _words_inside(words: DataFrame, names: DataFrame) -> DataFrame:
    """(word, name_word): the name words that are substrings of a text word, through an index of runs of four characters.

    A name word is looked up by its first four characters among those of every text word, and compared with the words
    met; each distinct word is looked at once, however many texts hold it.
    """
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("word") - (GRAM - 1)), lambda i: F.substring(F.col("word"), i, F.lit(GRAM))))
    index = words.select("word").distinct().select("word", F.explode(grams).alias("gram"))
    return index.join(names.select("name_word", F.substring("name_word", 1, GRAM).alias("gram")), "gram").where(F.col("word").contains(F.col("name_word"))).select("word", "name_word").distinct()


def _name_fallback(open_: DataFrame, docs: DataFrame, plans: DataFrame, key: str, text: str) -> DataFrame:
    """Per open (document, number) the plan whose name words fit the text clearly best, with the number's place.

    Name words and text words are runs of letters and digits, so a name word inside a text is inside one of its words:
    only (document, distinct word) rows leave the scan, no text does. A number in very many documents is split by the
    adaptive join, since the plans of one number are few.
    """
    # One candidate per plan; a plan listed on several rows ties with itself, and a tie is no clear win.
    cand = dimension.coded(plans).groupBy("num", "plan_norm").agg(F.min_by("strata_name", "row_no").alias("strata_name"), F.min("row_no").alias("row_no"), (F.count("*") > 1).alias("repeated"))
    cand = cand.join(open_.select("num").distinct(), "num", "left_semi")
    # A word that a name repeats counts again.
    named = cand.select("num", "plan_norm", "row_no", "repeated", F.explode(_long_words(F.upper(t.blank("strata_name")))).alias("name_word")).groupBy("num", "plan_norm", "row_no", "repeated", "name_word").agg(F.count("*").alias("times"))
    named = checkpointed(named)
    words = docs.select(key, text).join(open_.select(key).distinct(), key, "left_semi").select(key, F.array_distinct(_long_words(matchable(F.col(text)))).alias("words"))
    words = checkpointed(words.select(key, F.explode("words").alias("word")).distinct())
    found = words.join(_words_inside(words, named.select("name_word").distinct()), "word").select(key, "name_word").distinct()
    scored = (
        open_.select(key, "num", F.col("pos").alias("at")).join(named, "num").join(found, [key, "name_word"])
        .groupBy(key, "num", "at", "plan_norm", "row_no", "repeated").agg(F.least(F.lit(NAME_CAP), F.sum("times") * NAME_WORD).alias("name_score"))
    )
    w = Window.partitionBy(key, "num").orderBy(F.desc("name_score"), "row_no")
    top2 = scored.withColumn("rn", F.row_number().over(w)).where("rn <= 2")
    best = top2.groupBy(key, "num").agg(
        F.max(F.when(F.col("rn") == 1, F.col("name_score"))).alias("s1"), F.max(F.when((F.col("rn") == 2) | F.col("repeated"), F.col("name_score"))).alias("s2"),
        F.max(F.when(F.col("rn") == 1, F.col("plan_norm"))).alias("winner"), F.min("at").alias("pos"),
    )
    return best.where((F.col("s1") >= NAME_MIN) & (F.col("s2").isNull() | (F.col("s1") >= F.col("s2") + LEAD))).select(key, "num", "pos", "winner")


def _in_turn(won: DataFrame, key: str) -> DataFrame:
    """Numbers are taken in order of first appearance: one inside the number of a plan added before adds none.

    Only a longer number can hold a shorter one, so the numbers are settled by falling length, in as many steps as a
    number has digits, and in none where no number of a text lies in another.
    """
    won = checkpointed(won)
    inner = won.select(key, F.col("num").alias("by"), F.col("pos").alias("by_pos"), F.explode(_parts(F.col("num"), True)).alias("num"))
    within = checkpointed(inner.join(won.select(key, "num", "pos"), [key, "num"]).where("by_pos < pos").select(key, "num", "by"))
    if within.isEmpty():
        return won
    added = won.where(F.length("num") == DIGITS)
    for n in range(DIGITS - 1, 0, -1):
        held = within.join(added.select(key, F.col("num").alias("by")), [key, "by"], "left_semi").select(key, "num").distinct()
        added = checkpointed(added.unionByName(won.where(F.length("num") == n).join(held, [key, "num"], "left_anti")))
    return added


def _open_numbers(items: DataFrame, scores: DataFrame, key: str) -> DataFrame:
    """(key, num, pos) of the numbers that lie in no scored plan of their key.

    Most numbers lie in the plan that their own token scored. Only for keys with another number are the digits of all
    their plans laid out.
    """
    own = F.coalesce(F.col("hit.plan").contains(F.col("num")), F.lit(False))
    rest = stored(items.where("num <> ''").groupBy(key, "num").agg(F.min("pos").alias("pos"), F.max(own).alias("own")).where("not own").drop("own"))
    others = scores.select(key, "plan").join(rest.select(key).distinct(), key, "left_semi")
    digits = F.flatten(F.transform(F.regexp_extract_all("plan", F.lit(r"(?U)(\d+)")), lambda r: _parts(r)))
    return rest.join(others.select(key, F.explode(digits).alias("num")), [key, "num"], "left_anti")


def _best_two(scores: DataFrame, key: str, rows: DataFrame) -> DataFrame:
    """key, top: the two best plans of a key, the one picked, and its row in the list."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"), "pos"))
    two = scores.withColumn("rn", place).where("rn <= 2").groupBy(key).agg(*[F.max(F.when(F.col("rn") == r, F.struct("score", "plan"))).alias(f"r{r}") for r in (1, 2)])
    win = F.col("r2").isNull() | (F.col("r1.score") - F.col("r2.score") >= LEAD)
    top = two.withColumn("plan_norm", F.when(win, F.col("r1.plan"))).join(rows, "plan_norm", "left")
    return top.select(key, F.struct("r1", "r2", "plan_norm", "row", "is_base_fallback").alias("top"))


class Scores(NamedTuple):
    matched: DataFrame  # found, is_blank, explicit, top, detected
    by_plan: DataFrame  # found, plan, score, pos
    open: DataFrame  # found, num, pos of numbers that no scored plan explains
    rows: DataFrame  # plan_norm and its row in the list


def _scored(lists: DataFrame, plans: DataFrame) -> Scores:
    """J5 for the distinct findings `found`, without the name fallback.

    Scores are sums per (finding, plan) and the margin comes from the two best rows, so a text may hold any number of codes.
    """
    idx = checkpointed(_code_index(plans))
    tok = text_tokens(lists, plans, "found")
    base = F.regexp_replace("token", r"^([A-Z]{2,6}\d{1,5})[A-Z]{1,3}$", "$1")
    own = idx.select(F.col("code").alias("token"), F.col("own_row").isNotNull().alias("is_plan"), F.coalesce("shared", F.lit(False)).alias("is_shared"))
    dropped = idx.where("own_row is not null").select(F.col("code").alias("tok_base"), F.lit(True).alias("base_is_plan"))
    scored = tok.withColumn("tok_base", F.when(base != F.col("token"), base)).join(own, "token", "left").join(dropped, "tok_base", "left")
    plan_hit = (
        F.when(F.col("is_plan"), F.struct(F.col("token").alias("plan"), F.lit(EXACT).alias("w")))
        .when(F.col("base_is_plan"), F.struct(F.col("tok_base").alias("plan"), F.lit(SUFFIX_DROPPED).alias("w")))
        .when(F.col("tok_base").isNull() & F.col("is_shared"), F.struct(F.col("token").alias("plan"), F.lit(SHARED_MANAGER).alias("w")))
    )
    items = stored(scored.select("found", "pos", "token", "cnt", "num", plan_hit.alias("hit")))  # read several times below, written once
    hits = items.where(F.col("hit").isNotNull())
    scores = hits.groupBy("found", F.col("hit.plan").alias("plan")).agg(F.sum(F.col("hit.w") * F.col("cnt")).alias("score"), F.min("pos").alias("pos"))
    rows = idx.select(F.col("code").alias("plan_norm"), F.coalesce("own_row", "variant_row").alias("row"), F.col("own_row").isNull().alias("is_base_fallback"))

    place = F.row_number().over(Window.partitionBy("found").orderBy(F.desc("cnt"), "pos"))
    often = items.withColumn("rn", place).where("rn <= 10").groupBy("found").agg(F.array_sort(F.collect_list(F.struct("rn", "token", "cnt"))).alias("d"))
    often = often.select("found", F.transform("d", lambda x: F.struct(x["token"].alias("token"), x["cnt"].alias("cnt"))).alias("detected"))
    matched = stored(lists.select("found", "is_blank", "explicit").join(_best_two(scores, "found", rows), "found", "left").join(often, "found", "left"))
    return Scores(matched, scores, _open_numbers(items, scores, "found"), rows)


def _named(texts: DataFrame, hit: Scores, docs: DataFrame, plans: DataFrame, key: str, text: str) -> DataFrame:
    """(key, named): the best two plans of the texts (key, found; rows may repeat) to which the name fallback adds one (W7), ranked per text."""
    open_ = stored(texts.join(hit.open, "found").select(key, "num", "pos").distinct())
    added = stored(_in_turn(_name_fallback(open_, docs, plans, key, text), key).select(key, F.col("winner").alias("plan"), F.lit(BY_NAME).cast("long").alias("score"), (F.col("pos") + (1 << 50)).alias("pos")))
    of_theirs = texts.join(added.select(key).distinct(), key, "left_semi").distinct().join(hit.by_plan, "found").select(key, "plan", "score", "pos")
    return _best_two(of_theirs.unionByName(added), key, hit.rows).withColumnRenamed("top", "named")


def _facts() -> dict[str, Column]:
    """What is told of a text, from is_blank, explicit, top, detected."""
    note = (
        F.when(F.col("is_blank"), "No text extracted (scanned PDF?).")
        .when(F.col("top.plan_norm").isNotNull(), "")
        .when(F.col("top.r1").isNull(), "Detected plan text, but no match in list (or not safe to auto-pick).")
        .otherwise(F.concat(F.lit("Ambiguous: "), F.col("top.r1.plan"), F.lit(" vs "), F.col("top.r2.plan"), F.lit(". Leaving unmatched.")))
    )
    return {
        "text_plan": t.blank("top.plan_norm"), "text_note": note,
        "detected": F.coalesce("detected", F.array().cast("array<struct<token:string,cnt:bigint>>")),
        "is_base_fallback": F.coalesce("top.is_base_fallback", F.lit(False)),
        "row_plan": t.blank("top.row.plan_norm"), "row_manager": t.blank("top.row.manager_name"), "row_email": t.blank("top.row.manager_email"),
        "explicit": F.col("explicit"),
    }


def match_texts(scanned: DataFrame, plans: DataFrame, docs: DataFrame | None = None, key: str = "sha256", text: str = "content_text") -> DataFrame:
    """One row per document with the plan its text names, or why none was picked, and the codes it labels.

    Texts in which the scan found the same score alike, so each distinct finding is scored once, under its hash.
    `docs` (key, text) is read again only for the words of documents with a number that no scored plan explains (W7);
    these are ranked per document. Pass None to leave the name fallback out.
    """
    seen = F.struct(*LINKED)
    texts = scanned.select(key, F.unhex(F.sha2(F.to_json(seen), 256)).alias("found"), seen.alias("f"))
    hit = _scored(stored(texts.groupBy("found").agg(F.any_value("f").alias("f")).select("found", "f.*")), plans)
    out = texts.drop("f")
    if docs is not None:
        out = out.join(_named(out, hit, docs, plans, key, text), key, "left")
    else:
        out = out.withColumn("named", F.lit(None).cast(hit.matched.schema["top"].dataType))
    out = out.join(hit.matched, "found", "left").withColumn("top", F.coalesce("named", "top"))
    return out.select(key, *[c.alias(name) for name, c in _facts().items()])


def match_rows(rows: DataFrame, plans: DataFrame, text: str = "content_text") -> DataFrame:
    """J5 for each of the stored rows of `scan_rows`, with the columns of `match_texts`, all null where the text is; `f` and the text go.

    A row meets its finding once, under a key of 16 bytes. Only rows whose finding has an open number look up their own
    text's ranking too, so a text need not be a key of all rows.
    """
    full = rows.where("found is not null")
    hit = _scored(stored(full.select("found", "f.*").distinct()), plans)
    hit = hit._replace(open=stored(hit.open))
    named = _named(full.select("content", "found"), hit, full.select("content", text), plans, "content", text)
    facts = hit.matched.join(hit.open.select("found").distinct().withColumn("is_open", F.lit(True)), "found", "left").withColumn("is_open", F.coalesce("is_open", F.lit(False)))
    met = full.drop("f", text).join(facts, "found")
    opened = met.where("is_open").join(named, "content", "left").withColumn("top", F.coalesce("named", "top")).drop("named")
    both = met.where("not is_open").unionByName(opened)
    kept = [c for c in rows.columns if c not in ("f", "found", "content", text)]
    both = both.select(*kept, *[c.alias(name) for name, c in _facts().items()])
    return both.unionByName(rows.where("found is null").select(*kept), allowMissingColumns=True)


def detected_text(c="detected", n: int = 10) -> Column:
    return F.array_join(F.transform(F.slice(c, 1, n), lambda x: F.concat(x["token"], F.lit("x"), x["cnt"].cast("string"))), ", ")
