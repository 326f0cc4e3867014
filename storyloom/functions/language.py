"""Language rules as native expressions: letters by script, word evidence, detection, ingest rule, code repair."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode blocks that name a script, in the order in which equal counts are not decided.
SCRIPTS = {
    "deva": r"\x{0900}-\x{097F}", "beng": r"\x{0980}-\x{09FF}", "guru": r"\x{0A00}-\x{0A7F}", "gujr": r"\x{0A80}-\x{0AFF}", "orya": r"\x{0B00}-\x{0B7F}", "taml": r"\x{0B80}-\x{0BFF}",
    "telu": r"\x{0C00}-\x{0C7F}", "knda": r"\x{0C80}-\x{0CFF}", "mlym": r"\x{0D00}-\x{0D7F}", "arab": r"\x{0600}-\x{06FF}\x{0750}-\x{077F}\x{FB50}-\x{FDFF}\x{FE70}-\x{FEFF}",
    "mtei": r"\x{ABC0}-\x{ABFF}", "olck": r"\x{1C50}-\x{1C7F}",
}
LATIN = r"\x{0000}-\x{024F}"
# Scripts that one language alone uses.
SCRIPT_LANGUAGE = {"guru": "pa", "gujr": "gu", "orya": "or", "taml": "ta", "telu": "te", "knda": "kn", "mlym": "ml", "arab": "ur", "mtei": "mni", "olck": "sat"}
# Words and endings that speak for Marathi, Hindi, Nepali and romanised Hindi.
MARATHI_WORDS = (
    "आहे", "आहेत", "आणि", "होते", "झाले", "झाली", "केले", "केली", "नाही", "त्यांच्या", "त्यांनी", "यांच्या", "मध्ये", "साठी", "म्हणून", "पण", "आता", "हे", "ही", "या", "व",
    "तर", "असे", "करणार", "होणार", "दिली", "घेतला", "केला", "आली", "आला", "लागले", "काय", "कोण", "करेल", "घ्या", "तुम्ही", "आम्ही", "त्यांना", "ची", "चा", "चे", "चं",
    "जाणून", "कसे", "कसा", "कधी", "इथे", "तिथे", "आज", "उद्या", "मात्र", "म्हणजे", "होईल",
)
MARATHI_ENDINGS = ("च्या", "ांना", "ांनी", "तील", "थील", "ून", "णार", "णाऱ्या", "मध्ये", "लेल्या", "ल्याने", "लाही", "ताना", "तेय", "तोय", "लेले", "ल्यास", "णारे")
MARATHI_GENITIVE = "[ा-ौं]च[ाीे]"
MARATHI_LETTER = "ळ"
HINDI_WORDS = (
    "है", "हैं", "और", "में", "की", "के", "का", "को", "से", "पर", "ने", "भी", "था", "थी", "थे", "गया", "गई", "किया", "करने", "होगा", "रहा", "रही", "रहे", "लिए", "यह", "वह", "कि", "जो",
    "तो", "नहीं", "हुआ", "हुई", "बाद", "साथ", "अब", "एक", "कहा", "दिया",
)
NEPALI_WORDS = ("छ", "छन्", "गरेको", "भएको", "गर्न", "हुने", "पनि", "लागि", "थियो", "गरे", "भने")
ROMANISED_HINDI = (
    "hai", "hain", "ke", "ki", "ka", "ko", "mein", "aur", "nahi", "nahin", "kya", "bhi", "tha", "thi", "kar", "karne", "gaya", "gayi", "liye", "wala", "wali", "raha", "rahi",
    "hua", "hui", "kaha", "par", "se", "bhai", "sarkar", "ab", "yeh", "woh",
)
ASSAMESE_LETTERS = "ৰৱ"
# Codes that publishers write in place of the two-letter one.
CODE_FIXES = {
    "tn": "ta", "od": "or", "ori": "or", "hin": "hi", "eng": "en", "tam": "ta", "tel": "te", "mal": "ml", "kan": "kn", "mar": "mr", "ben": "bn", "guj": "gu", "pan": "pa", "urd": "ur", "asm": "as",
    "hindi": "hi", "english": "en", "tamil": "ta", "telugu": "te", "marathi": "mr", "bengali": "bn", "bangla": "bn", "gujarati": "gu", "kannada": "kn", "malayalam": "ml", "punjabi": "pa", "urdu": "ur",
    "odia": "or", "oriya": "or", "assamese": "as",
}
# Languages that detection settles against a declaration, and those in scope.
CERTAIN = ("mr", "bn", "as", "ta", "te", "kn", "ml", "gu", "or", "pa", "ur")
SCOPE = ("en", "hi")
WORD = r"[\p{L}\p{N}_\x{0900}-\x{0DFF}]+"
#: Function words of the stand-in for a statistical model: own choice, not the reference's.
FUNCTION_WORDS = {
    "en": ("the", "and", "of", "to", "is", "in", "that", "for"), "fr": ("le", "la", "les", "et", "des", "une", "est", "dans"),
    "de": ("der", "die", "und", "das", "ist", "nicht", "ein", "mit"), "es": ("el", "los", "y", "una", "que", "por", "con", "las"),
}


def letters(text: Column) -> Column:
    """Only the letters and combining marks of a text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}\p{Mn}\p{Mc}]", "")


def held(x: Column, use: Callable[[Column], Column]) -> Column:
    """use(x) with x computed once."""
    return F.get(F.transform(F.array(x), use), F.lit(0))


def in_block(only: Column, block: str) -> Column:
    return F.length(F.regexp_replace(only, f"[^{block}]", ""))


def script_counts(only: Column, latin: bool = True) -> Column:
    """array<struct(n, early, script)> over the letters of a text; `other` takes what no block holds.

    Arrays compare by (n, early), and early is larger the sooner a script appears, so array_max gives the leading one.
    """
    every = "".join(SCRIPTS.values()) + LATIN
    whole = -F.length(only)

    def one(name: str, n: Column, block: str) -> Column:
        """The letters of a block; its first one is looked for only where there is one."""
        early = lambda n: F.when(n > 0, -F.length(F.regexp_extract(only, f"^[{block}]*", 0))).otherwise(whole)
        return held(n, lambda n: F.struct(n.alias("n"), early(n).alias("early"), F.lit(name).alias("script")))

    def counted(foreign: Column) -> Column:
        """foreign: the letters that are not Latin; where there are none, no block is searched."""
        latn = [one("latn", F.length(only) - F.length(foreign), f"^{LATIN}")] if latin else []
        some = F.array(*[one(k, in_block(foreign, block), f"^{block}") for k, block in SCRIPTS.items()], *latn, one("other", F.length(F.regexp_replace(foreign, f"[{every}]", "")), every))
        fixed = lambda name, n, early: F.struct(n.alias("n"), early.alias("early"), F.lit(name).alias("script"))
        none = F.array(*[fixed(k, F.lit(0), whole) for k in SCRIPTS], *([fixed("latn", F.length(only), F.lit(0))] if latin else []), fixed("other", F.lit(0), whole))
        return F.when(foreign == "", none).otherwise(some)

    return held(F.regexp_replace(only, f"[{LATIN}]", ""), counted)


def hits(words: Column, known: tuple[str, ...]) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(*known)))


def devanagari_scores(text: Column) -> Column:
    """struct(mr, hi, ne): evidence for Marathi, Hindi and Nepali."""
    endings = f"(?:{'|'.join(MARATHI_ENDINGS)}|{MARATHI_GENITIVE})$"

    def scores(words: Column) -> Column:
        inflected = F.size(F.filter(words, lambda w: (F.length(w) > 3) & ~w.isin(*HINDI_WORDS) & w.rlike(endings)))
        mr = hits(words, MARATHI_WORDS) + 2 * (F.length(text) - F.length(F.replace(text, F.lit(MARATHI_LETTER), F.lit("")))) + inflected
        return F.struct(mr.alias("mr"), hits(words, HINDI_WORDS).alias("hi"), hits(words, NEPALI_WORDS).alias("ne"))

    return held(F.regexp_extract_all(text, F.lit(WORD), 0), scores)


def devanagari_language(scores: Column, tie: Column) -> Column:
    return held(scores, lambda s: F.when(s["ne"] > F.greatest(s["mr"], s["hi"]), "ne").when(s["mr"] > s["hi"], "mr").when(s["hi"] > s["mr"], "hi").otherwise(tie))


def romanised_hindi(text: Column) -> Column:
    words = F.transform(F.regexp_extract_all(text, F.lit("[A-Za-z]+"), 0), F.lower)
    counts = held(words, lambda w: F.struct(F.size(w).alias("n"), hits(w, ROMANISED_HINDI).alias("found")))
    return held(counts, lambda c: (c["n"] >= 4) & (c["found"] >= 3) & (c["found"] * 5 >= c["n"]))


def function_word_language(text: Column) -> Column:
    """Stand-in for a statistical model: the language whose function words are most frequent, null where none occurs."""
    words = F.transform(F.regexp_extract_all(text, F.lit(r"\p{L}+"), 0), F.lower)
    best = held(words, lambda ws: F.array_max(F.array(*[F.struct(hits(ws, w).alias("n"), F.lit(-k).alias("o"), F.lit(code).alias("code")) for k, (code, w) in enumerate(FUNCTION_WORDS.items())])))
    return held(best, lambda b: F.when(b["n"] > 0, b["code"]))


def with_detected(df, out: str, body: Column, description: Column, title: Column, fallback=function_word_language, least: int = 20, script: str | None = None):
    """df with the detected language of the richest text's first 3,000 characters.

    A script with half of the letters decides; else `fallback` (a function of the sample column) on texts of `least`
    characters or more; null under four letters.  `script` names a column for the leading script.  Intermediate columns keep each regex pass to one evaluation.
    """
    pick = lambda *texts: F.coalesce(*[held(F.regexp_replace(F.coalesce(t, F.lit("")), r"(?U)^\s+|\s+$", ""), lambda x: F.when(x != "", x)) for t in texts], F.lit(""))
    df = df.withColumn("_text", pick(body, description, title)).withColumn("_sample", F.left("_text", F.lit(3000)))
    df = df.withColumn("_only", letters(F.col("_sample"))).withColumn("_top", F.array_max(script_counts(F.col("_only"))))
    top, sample = F.col("_top.script"), F.col("_sample")
    own = F.when(F.col("_top.n") * 2 >= F.length("_only"), F.coalesce(*[F.when(top == k, v) for k, v in SCRIPT_LANGUAGE.items()], F.when(top == "beng", F.when(sample.rlike(f"[{ASSAMESE_LETTERS}]"), "as").otherwise("bn")), F.when(top == "deva", devanagari_language(devanagari_scores(sample), F.lit("hi"))), F.when((top == "latn") & romanised_hindi(sample), "hi-latn")))
    found = F.when(F.length("_only") < 4, None).otherwise(F.coalesce(own, F.when(F.length("_text") >= least, fallback(sample))))
    df = df.withColumn(out, found)
    return (df if script is None else df.withColumn(script, top)).drop("_text", "_sample", "_only", "_top")


def with_article_language(df, out: str, title: Column, description: Column, declared: Column):
    """df with the language by the ingest rule: the leading non-Latin script of title and description if it holds a
    quarter of four letters or more, or eight letters of a script other than Devanagari; else the declared one; else en."""
    df = df.withColumn("_said", F.lower(F.trim(F.coalesce(declared, F.lit("")))))
    df = df.withColumn("_text", F.left(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(description, F.lit(""))), F.lit(2000)))
    df = df.withColumn("_only", letters(F.col("_text"))).withColumn("_top", F.array_max(script_counts(F.col("_only"), latin=False)))
    top, n, said = F.col("_top.script"), F.col("_top.n"), F.col("_said")
    decides = (F.length("_only") >= 4) & (n > 0) & ((n * 4 >= F.length("_only")) | ((top != "deva") & (n >= 8)))
    tie = F.when(said.isin("mr", "ne"), said).otherwise("hi")
    name = F.coalesce(F.when(top == "deva", devanagari_language(devanagari_scores(F.col("_text")), tie)), *[F.when(top == k, v) for k, v in SCRIPT_LANGUAGE.items()], F.when(top == "beng", "bn"), top)
    return df.withColumn(out, F.when(decides, name).otherwise(F.coalesce(F.nullif(said, F.lit("")), F.lit("en")))).drop("_said", "_text", "_only", "_top")


def normal_code(code: Column) -> Column:
    """Two-letter code where one is known; '' if not."""
    c = F.replace(F.lower(F.trim(F.coalesce(code, F.lit("")))), F.lit("_"), F.lit("-"))
    base = F.substring_index(c, "-", 1)
    fixes = F.create_map(*[F.lit(x) for kv in CODE_FIXES.items() for x in kv])
    return F.coalesce(F.try_element_at(fixes, c), F.try_element_at(fixes, base), F.when(base.rlike(r"^\p{L}{2,3}$"), base), F.lit(""))
