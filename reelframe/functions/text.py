"""Text functions as Column expressions: they stay in the JVM and are pushed and pruned like any other expression.

Unless a function says otherwise, null in gives null out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The character classes and word lists that the results depend on.
NOT_HAN = "[^一-鿿㐀-䶿]"
INTERJECTION_CHARS = "啊哦嗯呢吧哈唉诶嘿喂哎呀哟咦嘛喔噢唔嗨咳嘻"
INTERJECTION_WORDS = ("嘿嘿", "哈哈", "呵呵", "嘻嘻")
TRAILING_PARTICLES = "啊哦嗯呢吧哈"
BEEP_CHARS = "兵叮丁"
BEEP_KEYWORDS = ("检测", "击杀", "发现", "警告", "获得", "提升", "吸收", "触发", "解锁", "激活", "任务", "恭喜")
LANGUAGES = (
    "Chinese", "English", "Cantonese", "Arabic", "German", "French", "Spanish", "Portuguese", "Indonesian", "Italian", "Korean", "Russian", "Thai",
    "Vietnamese", "Japanese", "Turkish", "Hindi", "Malay", "Dutch", "Swedish", "Danish", "Finnish", "Polish", "Czech", "Filipino", "Persian", "Greek",
    "Romanian", "Hungarian", "Macedonian",
)
CJK = r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}\x{2B740}-\x{2B81F}\x{2B820}-\x{2CEAF}\x{F900}-\x{FAFF}"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def chars(x: Column | str) -> Column:
    """The characters of a string as an array; empty for ''."""
    return F.filter(F.split(_c(x), ""), lambda c: c != "")


def bound(value: Column, fn) -> Column:  # noqa: ANN001
    """``fn`` of a value that is computed once, however often fn looks at it: inside a lambda an expression would be computed anew for each element."""
    return F.transform(F.array(value), fn)[0]


def han(x: Column | str) -> Column:
    """Han characters only."""
    return F.regexp_replace(_c(x), NOT_HAN, "")


def clamp_word_end(text: Column | str, start: Column | str, end: Column | str) -> Column:
    """A word ends at most 1.2 s a Han character (at least one) plus 1 s after its start."""
    return F.least(_c(end), _c(start) + F.greatest(F.length(han(text)), F.lit(1)) * 1.2 + 1.0)


def is_interjection(x: Column | str) -> Column:
    """Nothing but interjections (an empty text counts as one)."""
    t = F.trim(_c(x))
    return t.rlike(f"^[{INTERJECTION_CHARS}]*$") | t.isin(*INTERJECTION_WORDS)


def strip_trailing_particle(x: Column | str) -> Column:
    """One trailing particle off a text of three characters or more."""
    return F.regexp_replace(_c(x), f"^([\\s\\S]{{2,}})[{TRAILING_PARTICLES}]$", "$1")


def strip_beep(x: Column | str) -> Column:
    """P5: a beep heard as a character, off the front of a system message."""
    return F.regexp_replace(_c(x), f"^[{BEEP_CHARS}](?=(?:{'|'.join(BEEP_KEYWORDS)}))", "")


def srt_seconds(x: Column | str) -> Column:
    """H1: 'HH:MM:SS,mmm' to seconds; anything else, null too, is 0."""
    p = r"^(\d+):(\d+):(\d+),(\d+)"
    part = lambda i: F.regexp_extract(_c(x), p, i).cast("double")
    return F.when(_c(x).rlike(p), part(1) * 3600 + part(2) * 60 + part(3) + part(4) / 1000.0).otherwise(F.lit(0.0))


def srt_time(s: Column | str) -> Column:
    """H2: seconds to 'HH:MM:SS,mmm', every part truncated."""
    s = _c(s)
    return F.format_string(
        "%02d:%02d:%02d,%03d",
        F.floor(s / 3600).cast("long"),
        F.floor((s % 3600) / 60).cast("long"),
        F.floor(s % 60).cast("long"),
        F.floor((s % 1) * 1000).cast("long"),
    )


def flexible_seconds(x: Column | str) -> Column:
    """H3: 'HH:MM:SS.s', 'MM:SS.s' or 's' to seconds; what cannot be read, null too, is -1."""
    t = F.trim(_c(x))
    ok = t.rlike(r"^\d{1,9}(\.\d{1,6})?$|^(\d{1,9}:){1,2}\d{1,9}(\.\d{1,6})?$")
    fold = F.aggregate(F.split(t, ":"), F.lit(0.0), lambda a, p: a * 60 + p.cast("double"))
    return F.when(ok, fold).otherwise(F.lit(-1.0))


def padded_range(x: Column | str, pad: float = 0.5) -> Column:
    """H4: 'a-b' (or an en dash) to struct(s, e), padded and clamped at 0; null unless 0 <= a < b."""
    ends = F.split(_c(x), r"\s*[-–]\s*")
    s, e = flexible_seconds(F.element_at(ends, 1)), flexible_seconds(F.element_at(ends, -1))
    return F.when((F.size(ends) == 2) & (s >= 0) & (e > s), F.struct(F.greatest(s - pad, F.lit(0.0)).alias("s"), (e + pad).alias("e")))


def lcs_length(a: Column | str, b: Column | str) -> Column:
    """Length of the longest common subsequence, one row of the table at a time (for short texts)."""

    def table(bs: Column) -> Column:
        zero = F.transform(F.sequence(F.lit(0), F.size(bs)), lambda _: F.lit(0))

        def row(prev: Column, ch: Column) -> Column:
            # cur[j] = prev[j-1] + 1 if equal, else the greater of prev[j] and cur[j-1]
            start = F.array(F.lit(0))
            step = lambda cur, j: F.concat(
                cur,
                F.array(F.when(F.element_at(bs, j) == ch, F.element_at(prev, j) + 1).otherwise(F.greatest(F.element_at(prev, j + 1), F.element_at(cur, -1)))),
            )
            return F.when(F.size(bs) == 0, start).otherwise(F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(bs), F.lit(1))), start, step))

        return F.element_at(F.aggregate(chars(a), zero, row), -1)

    return bound(chars(b), table)


def lcs_ratio(a: Column | str, b: Column | str) -> Column:
    """H5: longest common subsequence over the greater length; 0 if either is empty."""
    m = F.greatest(F.length(_c(a)), F.length(_c(b)))
    return F.when((F.length(_c(a)) == 0) | (F.length(_c(b)) == 0), F.lit(0.0)).otherwise(lcs_length(a, b) / m)


def ordered_share(haystack: Column | str, needle: Column | str) -> Column:
    """H6: share of the needle's characters found in order; a miss uses the haystack up, so that nothing after it counts."""
    h = _c(haystack)
    end = F.length(h) + 1
    first = F.struct(F.lit(1).alias("j"), F.lit(0).alias("n"))

    def step(a: Column, ch: Column) -> Column:
        p = F.call_function("locate", ch, h, a["j"])
        return F.struct(F.when(p > 0, p + 1).otherwise(end).alias("j"), (a["n"] + F.when(p > 0, 1).otherwise(0)).alias("n"))

    return F.aggregate(chars(needle), first, step)["n"] / F.greatest(F.length(_c(needle)), F.lit(1))


def original_position(x: Column | str, clean_pos: Column | int) -> Column:
    """H8: where the Han character of a 0-based position among the Han characters stands in the whole text; its length if there is none."""
    cs = chars(x)
    at = F.filter(F.transform(cs, lambda c, i: F.when(~c.rlike(NOT_HAN), i)), lambda i: i.isNotNull())
    pos = F.lit(clean_pos) if isinstance(clean_pos, int) else clean_pos
    return F.coalesce(F.try_element_at(at, pos + 1), F.length(_c(x)))


def collapse_leading_repeat(x: Column | str) -> Column:
    """H9: Han text of five characters or more whose first 1 to 4 are said twice loses one of them; other text is kept as it is."""
    h = han(x)
    out = F.regexp_replace(h, r"^(.{1,4}?)\1", "$1")
    # The repeat must lie in the first half twice: 2 * n <= length, which the match itself ensures.
    return F.when((F.length(h) >= 5) & h.rlike(r"^(.{1,4}?)\1"), out).otherwise(_c(x))


def collapse_char_runs(x: Column | str, more_than: int = 20) -> Column:
    """A character more than 20 times in a row becomes one."""
    return F.regexp_replace(_c(x), rf"(?s)(.)\1{{{more_than},}}", "$1")


def replace_in_order(x: Column | str, pairs: list[tuple[str, str]]) -> Column:
    """Literal replacements, longest first (ties in the order given). Where the correct text ends with the wrong
    one, an occurrence that already stands behind the rest of it is left alone."""
    out = _c(x)
    for wrong, right in sorted(pairs, key=lambda p: -len(p[0])):
        q = lambda s: r"\Q" + s.replace("\\E", "\\E\\\\E\\Q") + r"\E"
        if right.endswith(wrong) and len(right) > len(wrong):
            out = F.regexp_replace(out, f"(?<!{q(right[: -len(wrong)])}){q(wrong)}", right.replace("\\", "\\\\").replace("$", "\\$"))
        else:
            out = F.replace(out, F.lit(wrong), F.lit(right))
    return out


def keep_unless_halved(before: Column | str, after: Column | str) -> Column:
    """A replacement that leaves at most half of four or more Han characters is taken back."""
    a, b = han(before), han(after)
    return F.when((a != b) & (F.length(a) >= 4) & (F.length(b) <= F.floor(F.length(a) / 2)), _c(before)).otherwise(_c(after))


def canonical_language(x: Column | str) -> Column:
    """P13: 'cHINese' -> 'Chinese'; null for null and blank."""
    t = F.trim(_c(x))
    return F.when(t != "", F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, 2, 1 << 30))))


def is_known_language(x: Column | str) -> Column:
    """Whether a language, in its canonical form, is one of the 30 that are known."""
    return canonical_language(x).isin(*LANGUAGES)


def merged_languages(xs: Column | str) -> Column:
    """A10: languages in order, without blanks and repeats of the one before, joined by commas."""
    ts = F.filter(F.transform(F.coalesce(_c(xs), F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))
    kept = bound(ts, lambda t: F.filter(t, lambda x, i: (i == 0) | (x != F.try_element_at(t, F.greatest(i, F.lit(1))))))
    return F.array_join(kept, ",")


def model_output(raw: Column | str) -> Column:
    """H13: 'language X<asr_text>T' to struct(language, text). No tag: all is text. Language 'None': silence if no text follows."""
    t = F.trim(_c(raw))
    tag = F.lit("<asr_text>")
    has = F.contains(t, tag)
    head = F.substring_index(t, "<asr_text>", 1)
    body = F.trim(F.substring(t, F.length(head) + F.length(tag) + 1, F.length(t)))
    lang = canonical_language(F.regexp_extract(head, r"(?im)^\s*language[ \t]+(\S[^\n]*)", 1))
    none = F.lower(head).contains("language none")
    empty = F.lit("")
    return (
        F.when(t.isNull() | (t == ""), F.struct(empty.alias("language"), empty.alias("text")))
        .when(~has, F.struct(empty.alias("language"), t.alias("text")))
        .when(none, F.struct(empty.alias("language"), body.alias("text")))
        .otherwise(F.struct(F.coalesce(lang, empty).alias("language"), body.alias("text")))
    )


def segments(answer: Column | str) -> Column:
    """The lines of an answer without numbering, pause marks and speaker; blank lines at the end are dropped."""
    line = lambda s: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.trim(s), r"^\d+[.、]\s*", ""), r"\[\d+\.\d+s\]", ""), r"^[\u4e00-\u9fff]{1,6}[：:]\s*", ""))  # noqa: E731, E501
    return F.transform(F.split(F.rtrim(F.regexp_replace(_c(answer), r"\s+$", "")), r"\r?\n"), line)


def json_object_text(answer: Column | str) -> Column:
    """The JSON object in an answer: code fences off, from the first brace to the last, ellipses out; null if there is none."""
    t = F.regexp_replace(_c(answer), r"```(?:json)?", "")
    obj = F.regexp_extract(t, r"(?s)(\{.*\})", 1)
    return F.when(obj != "", F.regexp_replace(obj, r",\s*(?:\.\.\.|…)\s*(?=[\]}])", ""))


def replacement_pair(line: Column | str) -> Column:
    """H16: 'wrong→right', 'wrong->right' or 'wrong | right' to struct(wrong, right); null if neither or equal."""
    p = r"^(.+?)(?:→|->|\s+\|\s+)(.+)$"
    t = F.trim(_c(line))
    w, r = F.trim(F.regexp_extract(t, p, 1)), F.trim(F.regexp_extract(t, p, 2))
    return F.when(t.rlike(p) & (w != "") & (r != "") & (w != r), F.struct(w.alias("wrong"), r.alias("right")))


def kept_chars(x: Column | str) -> Column:
    """Letters, digits (L*, N*) and apostrophes only."""
    return F.regexp_replace(_c(x), r"[^\p{L}\p{N}']", "")


def is_cjk(c: Column | str) -> Column:
    """Whether a character is a CJK ideograph (with the astral blocks)."""
    return _c(c).rlike(f"^[{CJK}]$")


def tokens(x: Column | str) -> Column:
    """Words of a mixed text: at white space, cleaned by ``kept_chars``, each CJK character a token of its own."""
    words = F.filter(F.transform(F.split(F.trim(_c(x)), r"\s+"), kept_chars), lambda w: w != "")
    return F.flatten(F.transform(words, lambda w: F.regexp_extract_all(w, F.lit(f"([{CJK}]|[^{CJK}]+)"), F.lit(1))))


def audio_kind(x: Column | str) -> Column:
    """H20: 'url', 'base64' (a data URL, or long text without a slash or backslash) or 'path'."""
    t = _c(x)
    return (
        F.when(t.rlike(r"^(?i:https?)://[^/\s]+"), "url")
        .when(t.startswith("data:audio") | ((F.length(t) > 256) & ~t.contains("/") & ~t.contains("\\")), "base64")
        .when(t.isNotNull(), "path")
    )


def base64_payload(x: Column | str) -> Column:
    """The bytes of a data URL or bare base64."""
    t = _c(x)
    return F.unbase64(F.when(t.startswith("data:") & t.contains(","), F.substring_index(t, ",", -1)).otherwise(t))


def natural_key(name: Column | str) -> Column:
    """a sort key under which runs of digits compare as numbers and other runs without case."""
    runs = F.regexp_extract_all(F.lower(_c(name)), F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.transform(runs, lambda r: F.when(r.rlike(r"^\d"), F.lpad(F.regexp_replace(r, r"^0+(?=\d)", ""), 20, "0")).otherwise(r))


def catalogue_line(parts: list[Column], sep: str = " | ") -> Column:
    """Fields side by side; arrays joined by '/'. Null fields are empty."""
    return F.concat_ws(sep, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def title_case(x: Column | str) -> Column:
    """Each word with a capital, the rest small, words split at '_' or white space."""
    ws = F.split(F.trim(F.regexp_replace(_c(x), r"[_\s]+", " ")), " ")
    return F.array_join(F.transform(ws, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30)))), " ")


def expand_placeholders(x: Column | str, marker: str, lengths: Column | str) -> Column:
    """The k-th marker is repeated lengths[k] times; a marker beyond the lengths stays single."""
    both = F.struct(F.split(_c(x), "\\Q" + marker + "\\E").alias("p"), _c(lengths).alias("n"))
    times = lambda v, i: F.coalesce(F.try_element_at(v["n"], i + 1), F.lit(1)).cast("int")
    return bound(both, lambda v: F.array_join(F.transform(v["p"], lambda p, i: F.when(i < F.size(v["p"]) - 1, F.concat(p, F.repeat(F.lit(marker), times(v, i)))).otherwise(p)), ""))


def manual_junctions(x: Column | str, clips: Column | int) -> Column:
    """H45: '3,7' to 0-based indices of junctions between clips; what is out of range or no number is left out."""
    n = F.lit(clips) if isinstance(clips, int) else clips
    nums = F.transform(F.split(_c(x), ","), lambda p: F.when(F.trim(p).rlike(r"^\d{1,9}$"), F.trim(p).cast("int") - 1))
    return F.filter(nums, lambda i: i.isNotNull() & (i >= 0) & (i < n - 1))


def prompt(template: Column | str, language: Column | str) -> Column:
    """The prompt, with the language forced where one is given."""
    lang = canonical_language(language)
    return F.when(lang.isNotNull(), F.concat(_c(template), F.lit("language "), lang, F.lit("<asr_text>"))).otherwise(_c(template))


def without_front_matter(x: Column | str) -> Column:
    """A prompt file without its front matter."""
    return F.regexp_replace(_c(x), r"(?s)^---.*?---\s*", "")


def base_name(path: Column | str) -> Column:
    """K9: the last part of a path."""
    return F.regexp_extract(_c(path), r"([^/\\]+)$", 1)


def episode_number(folder: Column | str) -> Column:
    """The episode in a folder's name ('第12集', or digits at its end); null if there is none."""
    n = F.coalesce(F.nullif(F.regexp_extract(_c(folder), r"第(\d+)集", 1), F.lit("")), F.nullif(F.regexp_extract(_c(folder), r"(\d+)\s*$", 1), F.lit("")))
    return n.cast("int")


def checkpoint_step(name: Column | str) -> Column:
    """The step of a 'checkpoint-N' directory; null for other names."""
    return F.nullif(F.regexp_extract(_c(name), r"^checkpoint-(\d+)$", 1), F.lit("")).cast("long")
