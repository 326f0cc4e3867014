"""Queries of the language rules over documents, every third of which opens with a phrase in another script."""

from __future__ import annotations

from pyspark.sql import functions as F

from storyloom.functions import language as L
from storyloom.operators.stories import read
from storyloom.plans.registry import query

#: Phrases by place; a document with doc_id % 3 = 0 opens with the phrase at doc_id div 3 % their number.
PHRASES = (
    "सरकार ने कहा कि योजना में बदलाव होगा", "राज्यातील शाळांची वेळ बदलणार आहे आणि", "सरकारले नयाँ नियम पनि लागू गरेको छ", "सनसनी तापमान", "পশ্চিমবঙ্গ সরকারের নতুন প্রকল্প", "অসম চৰকাৰৰ নতুন আঁচনি",
    "தமிழ்நாடு அரசு புதிய திட்டம்", "తెలంగాణ ప్రభుత్వం కొత్త పథకం", "ಕರ್ನಾಟಕ ಸರ್ಕಾರದ ಹೊಸ ಯೋಜನೆ", "കേരള സർക്കാർ പുതിയ പദ്ധതി", "ગુજરાત સરકારની નવી યોજના", "ਪੰਜਾਬ ਸਰਕਾਰ ਦੀ ਨਵੀਂ ਯੋਜਨਾ",
    "ଓଡ଼ିଶା ସରକାରଙ୍କ ନୂଆ ଯୋଜନା", "حکومت نے نئی پالیسی کا اعلان کیا", "Москва объявила новые правила", "sarkar ne kaha ki yeh yojana ab nahi hai", "quoted नमस्ते word in a long English headline here", "12", "नई दिल्ली trump blames ukraine", "ᱥᱟᱱᱛᱟᱲᱤ ᱯᱟᱹᱨᱥᱤ",
)

_P = ", ".join(f"'{p}'" for p in PHRASES)
#: id, title, description, body and declared language; the body is null for even ids, so that titles decide too.
_ARTICLES = f"""
a AS (SELECT doc_id AS id, CASE WHEN doc_id % 3 = 0 THEN ([{_P}])[CAST(doc_id // 3 % {len(PHRASES)} AS INTEGER) + 1] ELSE split_part(text, chr(10), 1) END AS title,
  CASE WHEN doc_id % 3 = 0 THEN NULL ELSE left(text, 60) END AS description, CASE WHEN doc_id % 3 <> 0 AND doc_id % 2 = 1 THEN text END AS body, CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN ' MR ' ELSE lang END AS declared, lang FROM documents)"""


def articles(spark, sf_dir):
    phrase = F.get(F.array(*[F.lit(p) for p in PHRASES]), F.expr(f"cast(doc_id div 3 % {len(PHRASES)} as int)"))
    other = F.col("doc_id") % 3 == 0
    declared = F.when(F.col("doc_id") % 5 == 0, None).when(F.col("doc_id") % 5 == 1, " MR ").otherwise(F.col("lang"))
    return read(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.when(other, phrase).otherwise(F.substring_index("text", "\n", 1)).alias("title"), F.when(~other, F.left("text", F.lit(60))).alias("description"),
        F.when(~other & (F.col("doc_id") % 2 == 1), F.col("text")).alias("body"), declared.alias("declared"), "lang",
    )


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


# The SQL side: scripts are rows that every text is joined with, so the leading one is an arg_max.
_BLOCKS = "blocks AS (SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in (L.SCRIPTS | {"latn": L.LATIN}).items()) + ") AS t(script, cls))"


def _counts(text: str, source: str) -> str:
    every = "".join(L.SCRIPTS.values()) + L.LATIN
    return f"""{_BLOCKS}, lt AS (SELECT id, {text} AS txt, regexp_replace({text}, '[^\\p{{L}}\\p{{Mn}}\\p{{Mc}}]', '', 'g') AS o FROM {source}),
sc AS (SELECT id, script, length(regexp_replace(o, '[^' || cls || ']', '', 'g')) AS n, length(regexp_extract(o, '^[^' || cls || ']*')) AS late FROM lt, blocks
  UNION ALL SELECT id, 'other', length(regexp_replace(o, '[{every}]', '', 'g')), length(regexp_extract(o, '^[{every}]*')) FROM lt)"""


def _deva(text: str) -> str:
    endings = "|".join(L.MARATHI_ENDINGS)
    words = f"regexp_extract_all({text}, '{L.WORD}')"
    return f"""struct_pack(mr := len(list_filter({words}, lambda w: list_contains({_list(L.MARATHI_WORDS)}, w))) + 2 * (length({text}) - length(replace({text}, '{L.MARATHI_LETTER}', '')))
  + len(list_filter({words}, lambda w: length(w) > 3 AND NOT list_contains({_list(L.HINDI_WORDS)}, w) AND regexp_matches(w, '({endings}|{L.MARATHI_GENITIVE})$'))),
  hi := len(list_filter({words}, lambda w: list_contains({_list(L.HINDI_WORDS)}, w))), ne := len(list_filter({words}, lambda w: list_contains({_list(L.NEPALI_WORDS)}, w))))"""


_OWN = "CASE script " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in L.SCRIPT_LANGUAGE.items()) + " END"


@query("x4_script_counts", f"WITH {_ARTICLES}, {_counts('title', 'a')} SELECT id, script, CAST(n AS INTEGER) AS n FROM sc WHERE n > 0")
def x4_script_counts(spark, sf_dir):
    """Letters of every title by script."""
    rows = articles(spark, sf_dir).select("id", L.letters(F.col("title")).alias("only"))
    return rows.select("id", F.explode(L.script_counts(F.col("only"))).alias("s")).filter("s.n > 0").select("id", "s.script", "s.n")


@query("x5_devanagari_scores", f"WITH {_ARTICLES}, s AS (SELECT id, {_deva('title')} AS s FROM a) SELECT id, CAST(s.mr AS INTEGER) AS mr, CAST(s.hi AS INTEGER) AS hi, CAST(s.ne AS INTEGER) AS ne FROM s WHERE s.mr + s.hi + s.ne > 0")
def x5_devanagari_scores(spark, sf_dir):
    rows = articles(spark, sf_dir).select("id", L.devanagari_scores(F.col("title")).alias("s"))
    return rows.filter("s.mr + s.hi + s.ne > 0").select("id", "s.mr", "s.hi", "s.ne")


@query("x6_romanised_hindi", f"""WITH {_ARTICLES}, w AS (SELECT id, list_transform(regexp_extract_all(coalesce(body, title), '[A-Za-z]+'), lambda x: lower(x)) AS w FROM a), h AS (SELECT id, len(w) AS n, len(list_filter(w, lambda x: list_contains({_list(L.ROMANISED_HINDI)}, x))) AS h FROM w)
SELECT id, n >= 4 AND h >= 3 AND h >= 0.2 * n AS romanised FROM h""")  # fmt: skip
def x6_romanised_hindi(spark, sf_dir):
    return articles(spark, sf_dir).select("id", L.romanised_hindi(F.coalesce("body", "title")).alias("romanised"))


_STANDIN = "(SELECT arg_max(code, n * 10 - o) FROM (VALUES " + ", ".join(f"('{c}', {k}, len(list_filter(w, lambda x: list_contains({_list(ws)}, x))))" for k, (c, ws) in enumerate(L.FUNCTION_WORDS.items())) + ") AS t(code, o, n) WHERE n > 0)"
_DETECTED = rf"""{_ARTICLES}, r AS (SELECT id, lang, coalesce(nullif(regexp_replace(coalesce(body, ''), '^\s+|\s+$', '', 'g'), ''), nullif(regexp_replace(coalesce(description, ''), '^\s+|\s+$', '', 'g'), ''), regexp_replace(coalesce(title, ''), '^\s+|\s+$', '', 'g')) AS whole FROM a),
{_counts('left(whole, 3000)', 'r')},
top AS (SELECT id, arg_max(script, n * 100000 - late) AS script, max(n) AS n FROM sc GROUP BY id),
ws AS (SELECT id, list_transform(regexp_extract_all(txt, '\p{{L}}+'), lambda x: lower(x)) AS w, list_transform(regexp_extract_all(txt, '[A-Za-z]+'), lambda x: lower(x)) AS aw FROM lt),
fw AS (SELECT id, w, len(aw) AS an, len(list_filter(aw, lambda x: list_contains({_list(L.ROMANISED_HINDI)}, x))) AS ah FROM ws),
det AS (SELECT r.id, r.lang, top.script, CASE WHEN length(lt.o) < 4 THEN NULL ELSE coalesce(CASE WHEN top.n * 2 >= length(lt.o) THEN coalesce({_OWN.replace('CASE script', 'CASE top.script')},
    CASE WHEN top.script = 'beng' THEN CASE WHEN regexp_matches(lt.txt, '[{L.ASSAMESE_LETTERS}]') THEN 'as' ELSE 'bn' END WHEN top.script = 'deva' THEN CASE WHEN s.ne > greatest(s.mr, s.hi) THEN 'ne' WHEN s.mr > s.hi THEN 'mr' ELSE 'hi' END
      WHEN top.script = 'latn' AND an >= 4 AND ah >= 3 AND ah * 5 >= an THEN 'hi-latn' END) END,
    CASE WHEN length(r.whole) >= 20 THEN {_STANDIN} END) END AS language
  FROM r JOIN lt ON lt.id = r.id JOIN top ON top.id = r.id JOIN fw ON fw.id = r.id JOIN (SELECT id, {_deva('txt')} AS s FROM lt) dv ON dv.id = r.id)"""


@query("x7_detect_language", f"WITH {_DETECTED} SELECT id, language FROM det")
def x7_detect_language(spark, sf_dir):
    """Detection from body, description or title; the stand-in of the statistical model counts function words."""
    out = L.with_detected(articles(spark, sf_dir), "language", F.col("body"), F.col("description"), F.col("title"))
    return out.select("id", "language")


_DECIDED = rf"""{_ARTICLES}, {_counts("left(coalesce(title, '') || ' ' || coalesce(description, ''), 2000)", 'a')},
top AS (SELECT id, arg_max(script, n * 100000 - late) AS script, max(n) AS n FROM sc WHERE script <> 'latn' GROUP BY id),
ing AS (SELECT a.id, lower(trim(coalesce(a.declared, ''))) AS said, CASE WHEN length(lt.o) >= 4 AND top.n > 0 AND (top.n * 4 >= length(lt.o) OR (top.script <> 'deva' AND top.n >= 8)) THEN
    CASE WHEN top.script = 'deva' THEN CASE WHEN s.ne > greatest(s.mr, s.hi) THEN 'ne' WHEN s.mr > s.hi THEN 'mr' WHEN s.hi > s.mr THEN 'hi' WHEN lower(trim(coalesce(a.declared, ''))) IN ('mr', 'ne') THEN lower(trim(a.declared)) ELSE 'hi' END
      WHEN top.script = 'beng' THEN 'bn' ELSE coalesce({_OWN.replace('CASE script', 'CASE top.script')}, top.script) END
  ELSE coalesce(nullif(lower(trim(coalesce(a.declared, ''))), ''), 'en') END AS language
  FROM a JOIN lt ON lt.id = a.id JOIN top ON top.id = a.id JOIN (SELECT id, {_deva('txt')} AS s FROM lt) dv ON dv.id = a.id)"""


@query("x8_article_language", f"WITH {_DECIDED} SELECT id, language FROM ing")
def x8_article_language(spark, sf_dir):
    out = L.with_article_language(articles(spark, sf_dir), "language", F.col("title"), F.col("description"), F.col("declared"))
    return out.select("id", "language")


@query("f5_language_scope", f"WITH {_DECIDED} SELECT id FROM ing WHERE language IN ('en', 'hi')")
def f5_language_scope(spark, sf_dir):
    return x8_article_language(spark, sf_dir).filter(F.col("language").isin(*L.SCOPE)).select("id")


@query("f8_purge_decision", f"WITH {_DETECTED.replace(' top AS', ' dtop AS')}, d2 AS (SELECT id, language AS detected FROM det), f AS (WITH {_DECIDED} SELECT id, language FROM ing) SELECT f.id, CASE WHEN detected IN {L.CERTAIN} THEN detected ELSE f.language END NOT IN ('en', 'hi') AS purge FROM f JOIN d2 ON d2.id = f.id".replace(" dtop AS", " top AS"))
def f8_purge_decision(spark, sf_dir):
    """Out of scope by the ingest rule, unless detection by script settles it otherwise."""
    rows = L.with_article_language(articles(spark, sf_dir), "ruled", F.col("title"), F.col("description"), F.col("declared"))
    rows = L.with_detected(rows, "detected", F.col("body"), F.col("description"), F.col("title"))
    language = F.when(F.col("detected").isin(*L.CERTAIN), F.col("detected")).otherwise(F.col("ruled"))
    return rows.select("id", (~language.isin(*L.SCOPE)).alias("purge"))


_RAW = "CASE doc_id % 8 WHEN 0 THEN lang || '_IN' WHEN 1 THEN ' TN ' WHEN 2 THEN 'x' WHEN 3 THEN lang || '-latn' WHEN 4 THEN 'Hindi' WHEN 5 THEN 'klingon' WHEN 6 THEN NULL ELSE 'eng-US' END"


@query("x9_language_code", "WITH c AS (SELECT doc_id, replace(lower(trim(coalesce(" + _RAW + ", ''))), '_', '-') AS c FROM documents), fix AS (SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in L.CODE_FIXES.items()) + r""") AS t(k, v))
SELECT c.doc_id, coalesce(f.v, g.v, CASE WHEN regexp_full_match(split_part(c, '-', 1), '\p{L}{2,3}') THEN split_part(c, '-', 1) END, '') AS code FROM c LEFT JOIN fix f ON f.k = c.c LEFT JOIN fix g ON g.k = split_part(c.c, '-', 1)""")  # fmt: skip
def x9_language_code(spark, sf_dir):
    raw = F.expr(_RAW.replace("lang || '_IN'", "concat(lang, '_IN')").replace("lang || '-latn'", "concat(lang, '-latn')"))
    return read(spark, sf_dir, "documents").select("doc_id", L.normal_code(raw).alias("code"))


@query("a21_language_accuracy", f"""WITH {_DETECTED} SELECT lang, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (split_part(coalesce(language, ''), '-', 1) = lang) AS BIGINT) AS right_n,
CAST(count(*) FILTER (script = 'latn') AS BIGINT) AS consistent, CAST(count(*) FILTER (script = 'latn' AND split_part(coalesce(language, ''), '-', 1) = lang) AS BIGINT) AS consistent_right FROM det GROUP BY lang""")  # fmt: skip
def a21_language_accuracy(spark, sf_dir):
    """Detected against given language: all rows, and those whose leading script is the one of the language (Latin for all four)."""
    rows = L.with_detected(articles(spark, sf_dir), "language", F.col("body"), F.col("description"), F.col("title"), script="script")
    right = F.substring_index(F.coalesce("language", F.lit("")), "-", 1) == F.col("lang")
    latin = F.col("script") == "latn"
    return rows.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(right).alias("right_n"), F.count_if(latin).alias("consistent"), F.count_if(latin & right).alias("consistent_right"))
