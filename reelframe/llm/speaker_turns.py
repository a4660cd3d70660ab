"""Speech transcripts into clean speaker turns by a semi-Markov conditional model."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelframe.functions.text import NOT_HAN
from reelframe.session import cut, spread

# Fixed values of the transcripts: time stamps, markers of a label, sound annotations, hesitations.
_STAMP = re.compile(
    r"\s*(?:"
    r"\[(?P<h1>\d+):(?P<m1>\d+):(?P<s1>\d+(?:[.,]\d+)?)\]|"
    r"\(((?P<h2>\d+):)?(?P<m2>\d+):(?P<s2>\d+(?:[.,]\d+)?)\)|"
    r"<(?P<s3>\d+(?:\.\d+)?)s>|"
    r"@(?P<h4>\d+):(?P<m4>\d+):(?P<s4>\d+(?:\.\d+)?)|"
    r"(?:(?P<h5>\d+)时)?(?P<m5>\d+)分(?P<s5>\d+(?:\.\d+)?)秒|"
    r"(?P<h6>\d+):(?P<m6>\d+):(?P<s6>\d+[.,]\d+)[ \t]*-->[ \t]*[\d:.,]+"
    r")[ \t]*"
)
_LEAD = re.compile(r"\s*(?:>>|-+|—+)?\s*")
_BRACKETED = re.compile(r"(?:【([^】]+)】|\[([^\]]+)\]|<([^>]+)>)\s*[:：]?")
_SIDE = r"(?:\s*[（(][^）)]*[）)]|\s*(?:V\.?O\.?|O\.?S\.?)(?![A-Za-z]))*"
_COLON = re.compile(rf"([^：:，。！？…,.!?（(\[【<>♪*\n]+?){_SIDE}\s*[：:]")
_ANNOTATION = re.compile(r"\(\([^)]*\)\)|（[^）]*）|\([^)]*\)|【[^】]*】|\[[^\]]*\]|<[^>]*>|\*[^*]*\*|♪+[^♪]*♪+|♪+")
_HESITATION = ("就是说", "那个", "嗯", "呃", "额", "诶", "啊这", "um", "uh", "erm", "hmm")
_HES = "|".join(_HESITATION)
_JOINT = r"[\s，,、。.…—!！?？~-]"
#: A hesitation counts where it stands by itself: bounded by punctuation, or at the head of a line before more of them.
_HEAD = re.compile(rf"^(?:{_JOINT}*(?:{_HES})(?={_JOINT}|$){_JOINT}*)+", re.I)
_INNER = re.compile(rf"(?<={_JOINT[:-1]}])(?:{_HES})(?={_JOINT}|$){_JOINT}*", re.I)

#: Features of a turn in the model's order.
FEATURES = (
    "label names the speaker", "label is close to the speaker", "label names another", "no label at the start", "label inside names the speaker",
    "label inside names another", "short pause before", "long pause before", "unknown pause before", "text goes on", "further line", "log lines",
    "no words at the start", "no words in a further line",
)
#: A section of a recording in seconds, and in lines, that is decoded as one.
SECTION_S, SECTION_LINES = 3600, 512
#: Lines that the model is fitted on at most, in pieces of so many lines; the rest of the data takes no part in the fit.
TRAIN_LINES, TRAIN_PIECE = 1024, 16
#: Letters of an episode's code that name its series.
SERIES_LETTERS = 7


def plain_name(s: str | None) -> str:
    """A name or label in its compared form: NFKC, lower case, no white space, '_' or '-', no leading zeros of a number."""
    s = re.sub(r"[\s_\-]+", "", unicodedata.normalize("NFKC", s or "").lower())
    return re.sub(r"(?<=\D)0+(?=\d)", "", s)


def clean_line(s: str) -> str:
    """A line's spoken words: without annotations and hesitations."""
    s = _ANNOTATION.sub("", s).strip()
    s = _HEAD.sub("", s)
    return _INNER.sub("", s).strip()


def _letters(s: str) -> str:
    return "".join(c for c in s if c.isalnum())


def _seconds(m: re.Match) -> float:
    g = m.groupdict()
    for i in "123456":
        if g.get(f"s{i}"):
            return int(g.get(f"h{i}") or 0) * 3600 + int(g.get(f"m{i}") or 0) * 60 + float(g[f"s{i}"].replace(",", "."))
    return 0.0


class Cast:
    """The cast of a series: whom a label can name."""

    def __init__(self, names: list[tuple[str | None, str | None]]) -> None:
        self.speakers = sorted({p for _, p in names if p})
        index = {p: i for i, p in enumerate(self.speakers)}
        self.names = {plain_name(p): i for i, p in enumerate(self.speakers)}
        self.exact = {plain_name(a): index[p] for a, p in names if a and p} | self.names

    def resolve(self, label: str) -> tuple[tuple[int, ...], bool] | None:
        """(speakers, exact) that a label can name: of that name or alias, else those whose name has one character changed, lacking or added.

        Aliases are short common words, so that a near one is more often a sound annotation than a slip.
        """
        x = plain_name(label)
        if not x:
            return None
        if x in self.exact:
            return (self.exact[x],), True
        near = sorted({i for n, i in self.names.items() if len(n) > 1 and len(x) > 1 and _one_off(x, n)})
        return (tuple(near), False) if near else None


def _one_off(a: str, b: str) -> bool:
    if any(c.isascii() for c in a + b):  # spk1 and spk2 are two speakers
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1 or min(len(a), len(b)) < 2:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@dataclass
class Line:
    text: str  # spoken words
    label: tuple[int, ...] = ()
    exact: bool = False
    time: float | None = None
    stamped: bool = False
    spoken: bool = False  # holds words, be they hesitations: what an item is made of
    words: str = field(default="", repr=False)


def parse_chunk(text: str | None, items: list | None, offset: float | None, cast: Cast) -> list[Line]:
    """The lines of a chunk with label, spoken words and time (seconds in the recording; null where nothing tells)."""
    lines: list[Line] = []
    pending: float | None = None
    for raw in re.split(r"\r\n|\r|\n", text or ""):
        s, time = raw, None
        if m := _STAMP.match(s):
            time, s = _seconds(m), s[m.end() :]
            if not s.strip():
                pending = time
                continue
        if not s.strip():
            continue
        if time is None:
            time, pending = pending, None
        s = s[_LEAD.match(s).end() :]
        head = s
        while True:  # annotations may stand before the label
            if m := _BRACKETED.match(head):
                if who := cast.resolve(re.sub(_SIDE + r"$", "", next(g for g in m.groups() if g))):
                    break
                head = head[m.end() :].lstrip()
                continue
            if (m := _COLON.match(head)) and (who := cast.resolve(m[1])):
                break
            if (a := _ANNOTATION.match(head)) and a.end():
                head = head[a.end() :].lstrip()
                continue
            m = who = None
            break
        line = Line("", *(who or ((), False)), time, time is not None)
        body = _ANNOTATION.sub("", head[m.end() :] if m else s)
        line.spoken = bool(_letters(body))
        line.text = clean_line(body)
        if not _letters(line.text):
            line.text = ""
        line.words = _letters(line.text)
        lines.append(line)
    if items:
        spoken = [k for k in lines if k.spoken]
        at = [((offset or 0.0) + i["start_time"], _letters(i["text"] or "")) for i in items if i is not None and i["start_time"] is not None]
        _place(spoken, at)
    last = None
    for k in lines:  # a line of no time of its own stands after the one before it
        if k.time is None:
            k.time = last
        last = k.time if k.time is not None else last
    for k in reversed(lines):
        if k.time is None:
            k.time = last if last is not None and k is lines[-1] else (offset or 0.0)
    return lines


def _place(spoken: list[Line], at: list[tuple[float, str]]) -> None:
    """Give lines the times of the items of their words; lines may be out of the items' order, stamps decide between equal words."""
    free: dict[str, list[float]] = {}
    for t, w in at:
        free.setdefault(w, []).append(t)
    left: list[Line] = []
    for k in spoken:
        c = free.get(k.words) if k.words else None
        if c:
            t = min(c, key=lambda t: abs(int(t + 1e-6) - int(k.time)) if k.stamped else 0)
            c.remove(t)
            k.time = t
        else:
            left.append(k)
    rest = sorted(t for c in free.values() for t in c)
    for k in [k for k in left if k.stamped]:
        c = [t for t in rest if int(t + 1e-6) == int(k.time)]
        if c:
            k.time = c[0]
            rest.remove(c[0])
            left.remove(k)
    left = [k for k in left if not k.stamped]
    if len(left) == len(rest):
        for k, t in zip(left, rest):
            k.time = t


def _pause(a: Line | None, b: Line) -> np.ndarray:
    gap = b.time - a.time - 0.2 * len(a.words) if a is not None and a.time is not None and b.time is not None else None
    return np.array([gap is not None and gap < 0.5, gap is not None and gap >= 0.5, gap is None], float)


def _goes_on(a: Line | None, b: Line) -> float:
    """Lexical continuity: the share of character pairs of a line that the line before has too."""
    if a is None or not a.words or not b.words:
        return 0.0
    x, y = ({w[i : i + 2] for i in range(len(w) - 1)} or {w} for w in (a.words, b.words))
    return len(x & y) / len(y)


def _features(lines: list[Line], speakers: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, inside): features of each line as the first of a turn, and as a further line, for each speaker."""
    t, f = len(lines), len(FEATURES)
    start, inside = np.zeros((t, speakers, f)), np.zeros((t, speakers, f))
    for i, k in enumerate(lines):
        before = lines[i - 1] if i else None
        if k.label:
            start[i, :, 2] = inside[i, :, 5] = 1
            for s in k.label:
                start[i, s, 2] = inside[i, s, 5] = 0
                start[i, s, 0 if k.exact else 1] = 1
                inside[i, s, 4] = 1
        else:
            start[i, :, 3] = 1
        start[i, :, 6:9] = _pause(before, k)
        start[i, :, 9] = _goes_on(before, k)
        inside[i, :, 10] = 1
        start[i, :, 12] = inside[i, :, 13] = not k.words
    return start, inside


#: Scores that stand for "cannot be": the speaker before the section goes on only at its head, turns of one speaker join.
_NEVER = -1e9


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class TurnModel:
    """A semi-Markov conditional model of turns: p(turns | lines) with a weight for each feature.

    The score of a turn (first line, last line, speaker) is the weighted sum of the features of its label, the
    pause before it, its lexical continuity, its further lines, lines without words and its length; neighbouring turns have different speakers.
    """

    def __init__(self, weights: np.ndarray | None = None) -> None:
        self.w = np.zeros(len(FEATURES)) if weights is None else np.asarray(weights, float)

    def to_json(self) -> str:
        return json.dumps(dict(zip(FEATURES, self.w.tolist())), ensure_ascii=False)

    @staticmethod
    def from_json(s: str) -> TurnModel:
        return TurnModel(np.array([json.loads(s)[f] for f in FEATURES]))

    def _scores(self, lines: list[Line], a: np.ndarray, b: np.ndarray, speakers: int) -> None:
        """Fill in the scores of each line as the first of a turn (a) and as a further one (b); column ``speakers`` is who spoke before the section."""
        w, none = self.w, speakers
        before = None
        for i, k in enumerate(lines):
            first = float(_pause(before, k) @ w[6:9]) + w[9] * _goes_on(before, k) + (0.0 if k.words else w[12])
            more = w[10] + (0.0 if k.words else w[13])
            if k.label:
                a[i, :none], b[i, :none] = first + w[2], more + w[5]
                for s in k.label:
                    a[i, s], b[i, s] = first + w[0 if k.exact else 1], more + w[4]
                b[i, none] = _NEVER  # a label ends the carried turn
            else:
                a[i, :none], b[i, : none + 1] = first + w[3], more
            a[i, none] = _NEVER
            before = k
        if lines and not lines[0].label:
            a[0, none] = 0.0  # who spoke before goes on without a start

    def decode(self, lines: list[Line], speakers: int) -> list[tuple[int, int, int]]:
        """The best turns: (first line, line after the last, speaker); speaker = ``speakers`` for whoever spoke before."""
        return self.decode_many([(lines, speakers)])[0]

    def decode_many(self, sections: list[tuple[list[Line], int]]) -> list[list[tuple[int, int, int]]]:
        """``decode`` for several sections at once; sections of about the same length go together."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in sections]
        order = sorted((i for i, (x, _) in enumerate(sections) if x), key=lambda i: len(sections[i][0]))
        while order:
            least = len(sections[order[0]][0])
            n = next((k for k, i in enumerate(order) if len(sections[i][0]) > 1.3 * least + 8), len(order))
            for i, turns in zip(order[:n], self._decode_padded([sections[i] for i in order[:n]])):
                out[i] = turns
            order = order[n:]
        return out

    def _decode_padded(self, sections: list[tuple[list[Line], int]]) -> list[list[tuple[int, int, int]]]:
        p, t, n = len(sections), max(len(x) for x, _ in sections), max(k for _, k in sections) + 1
        a, b = np.full((p, t, n), _NEVER), np.zeros((p, t, n))
        for i, (lines, speakers) in enumerate(sections):
            self._scores(lines, a[i, : len(lines), : speakers + 1], b[i, : len(lines), : speakers + 1], speakers)
        c = np.concatenate((np.zeros((p, 1, n)), np.cumsum(b, axis=1)), axis=1)
        length = self.w[11] * np.log1p(np.arange(t + 1))
        # head: the best way up to line i and a turn that begins there, but for what follows in the turn.
        head = np.full((p, t, n), _NEVER)
        head[:, 0] = a[:, 0] - c[:, 1]
        best = np.full((p, t + 1, n), -np.inf)  # of turns that end before line e, by the last speaker
        back, who = np.zeros((p, t + 1, n), np.int32), np.zeros((p, t + 1, n), np.int16)
        rows = np.arange(p)
        for e in range(1, t + 1):
            seg = head[:, :e] + length[e - np.arange(e)][None, :, None]
            back[:, e] = seg.argmax(axis=1)
            best[:, e] = np.take_along_axis(seg, back[:, e][:, None].astype(np.int64), axis=1)[:, 0] + c[:, e]
            if e < t:
                first = best[:, e].argmax(axis=1)
                others = best[:, e].copy()
                top = others[rows, first]
                others[rows, first] = -np.inf
                second = others.argmax(axis=1) if n > 1 else first
                enter = np.repeat(top[:, None], n, axis=1)
                who[:, e] = first[:, None]
                enter[rows, first] = others[rows, second] if n > 1 else _NEVER
                who[rows, e, first] = second
                head[:, e] = enter + a[:, e] - c[:, e + 1]
        got = []
        for i, (lines, _) in enumerate(sections):
            e = len(lines)
            s, turns = int(best[i, e].argmax()), []
            while e > 0:
                lo = int(back[i, e, s])
                turns.append((lo, e, s))
                e, s = lo, int(who[i, lo, s])
            got.append(turns[::-1])
        return got

    def fit(self, sample: list[tuple[list[Line], int, list[int]]], rounds: int = 40, rate: float = 0.5, penalty: float = 1e-3) -> TurnModel:
        """Maximum conditional likelihood by gradient steps (Adam) over (lines, speakers, speaker of each line or -1 where it is not known).

        The gradient is the difference of the expected features with the known speakers held and without.
        """
        data = [x for x in sample if x[0] and x[1] and any(y >= 0 for y in x[2])]
        if not data:
            return self
        p, t, n = len(data), max(len(x[0]) for x in data), max(x[1] for x in data)
        start, inside = np.zeros((2, p, t, n, len(FEATURES)))
        blocked = np.zeros((2, p, t, n), bool)
        for i, (lines, k, gold) in enumerate(data):
            start[i, : len(lines), :k], inside[i, : len(lines), :k] = _features(lines, k)
            blocked[:, i, :, k:] = True
            for j, y in enumerate(gold):
                if y >= 0:
                    blocked[1, i, j] = True
                    blocked[1, i, j, y] = False
        sizes = np.array([len(x[0]) for x in data])
        m = v = np.zeros_like(self.w)
        for step in range(1, rounds + 1):
            grad = (self.expected(start, inside, sizes, blocked[1]) - self.expected(start, inside, sizes, blocked[0])) / p - penalty * self.w
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
            self.w = self.w + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return self

    def expected(self, start: np.ndarray, inside: np.ndarray, sizes: np.ndarray, blocked: np.ndarray) -> np.ndarray:
        """Expected features of the turns under the model, summed over pieces, by forward and backward sums over turns.

        start, inside: (pieces, lines, speakers, features), padded; sizes: lines of each piece; blocked: (pieces, lines, speakers), what a line cannot be.
        """
        p, t, n = blocked.shape
        never = np.where(blocked, _NEVER, 0.0)
        a, b = start @ self.w + never, inside @ self.w + never
        c = np.concatenate((np.zeros((p, 1, n)), np.cumsum(b, axis=1)), axis=1)
        logs = np.log1p(np.arange(t + 1))
        i, e = np.arange(t)[:, None], np.arange(t + 1)[None, :]
        span = np.where(e > i, logs[np.maximum(e - i, 0)], 0.0)
        # seg[i, e]: a turn of lines i to e - 1.
        seg = (a - c[:, 1:])[:, :, None] + c[:, None] + (self.w[11] * span)[None, :, :, None] + np.where(e > i, 0.0, _NEVER)[None, :, :, None]
        apart = np.where(np.eye(n, dtype=bool), _NEVER, 0.0)
        fwd, enter = np.full((p, t + 1, n), _NEVER), np.full((p, t + 1, n), _NEVER)
        enter[:, 0] = 0.0
        for k in range(1, t + 1):
            fwd[:, k] = _log_sum(enter[:, :k] + seg[:, :k, k], 1)
            enter[:, k] = _log_sum(fwd[:, k, :, None] + apart, 1)
        rows = np.arange(p)
        z = _log_sum(fwd[rows, sizes], 1)
        bwd = np.full((p, t + 1, n), _NEVER)
        bwd[rows, sizes] = 0.0
        for k in range(t - 1, 0, -1):  # bwd[k]: of what follows a turn that ends before line k
            follow = _log_sum(_log_sum(seg[:, k, k + 1 :] + bwd[:, k + 1 :], 1)[:, :, None] + apart, 1)
            bwd[:, k] = np.where((k < sizes)[:, None], follow, bwd[:, k])
        prob = np.exp(np.minimum(enter[:, :t, None] + seg + bwd[:, None] - z[:, None, None, None], 0.0))
        prob *= (e > i)[None, :, :, None] & (e[None] <= sizes[:, None, None])[..., None]
        later = np.cumsum(prob[:, :, ::-1], axis=2)[:, :, ::-1]  # turns from i that end at e or later
        goes = (later[:, :, 1:] * (i < np.arange(t)[None, :])[None, :, :, None]).sum(axis=1)
        g = np.einsum("pts,ptsf->f", prob.sum(axis=2), start) + np.einsum("pts,ptsf->f", goes, inside)
        g[11] += (prob.sum(axis=(0, 3)) * span).sum()
        return g


def _name(c: str):  # noqa: ANN202
    """A name without the white space around it."""
    return F.regexp_replace(c, r"^[\s\u3000]+|[\s\u3000]+$", "")


def _cast_table(aliases: DataFrame) -> DataFrame:
    """series, cast: the (alias, speaker) pairs of each series."""
    listed = aliases.select("series", "alias", _name("speaker").alias("speaker")).where("speaker <> ''")
    return listed.distinct().groupBy("series").agg(F.array_sort(F.collect_list(F.struct("alias", "speaker"))).alias("cast"))


_LINE = "orig_index int, chunk_index int, line_no int, t_ms long, label array<string>, exact boolean, text string, spoken boolean, nth int, episode string"


def transcript_lines(chunks: DataFrame, aliases: DataFrame, series_letters: int = SERIES_LETTERS) -> DataFrame:
    """The lines of all recordings' chunks, each chunk in its latest version; what overlapping chunks share comes once a chunk.

    nth numbers equal lines of one time within a chunk, so that the k-th of one chunk is the k-th of its neighbour, and all of them stay.
    """
    rows = chunks.where("orig_index IS NOT NULL").select(
        "orig_index", "chunk_index", F.struct("episode", "offset_sec", "text", "items").alias("v"), F.struct("loaded_at", F.xxhash64("text", "offset_sec")).alias("o")
    )
    rows = rows.groupBy("orig_index", "chunk_index").agg(F.max_by("v", "o").alias("v")).select("orig_index", "chunk_index", "v.*")
    rows = rows.join(_cast_table(aliases), F.left("episode", F.lit(series_letters)) == F.col("series"), "left")

    def parse(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        casts: dict[tuple, Cast] = {}
        for pdf in it:
            out: list[tuple] = []
            for r in pdf.itertuples(index=False):
                names = tuple((x["alias"], x["speaker"]) for x in r.cast) if r.cast is not None else ()
                if names not in casts:
                    casts = {names: Cast(list(names))}  # rows of a series mostly follow each other
                cast = casts[names]
                items = None if r.items is None else list(r.items)
                offset = None if r.offset_sec != r.offset_sec else r.offset_sec
                chunk, seen = 0 if r.chunk_index != r.chunk_index else r.chunk_index, {}
                for no, k in enumerate(parse_chunk(r.text, items, offset, cast)):
                    key = (round(k.time * 1000), k.label, k.exact, k.text, k.spoken)
                    seen[key] = nth = seen.get(key, 0) + 1
                    out.append((r.orig_index, chunk, no, key[0], [cast.speakers[i] for i in k.label], k.exact, k.text, k.spoken, nth, r.episode))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _LINE.split(", ")])

    return rows.select("orig_index", "chunk_index", "episode", "offset_sec", "text", "items", "cast").mapInPandas(parse, _LINE)


#: What makes lines of two chunks the same line.
_SAME = ["t_ms", "label", "exact", "text", "spoken", "nth"]


def _as_lines(t_ms: list, labels: list, exact: list, text: list, spoken: list, more: set[str] = frozenset()) -> tuple[list[Line], list[str]]:
    """(lines, names): names are the speakers that the labels name, and ``more``."""
    names = sorted({s for x in labels for s in x} | more)
    at = {s: i for i, s in enumerate(names)}
    return [Line(x, tuple(at[s] for s in l), bool(e), t / 1000, True, bool(z), _letters(x)) for t, l, e, x, z in zip(t_ms, labels, exact, text, spoken)], names


def training_pieces(lines: DataFrame, script: DataFrame, most: int = TRAIN_LINES, piece: int = TRAIN_PIECE) -> list[tuple[list[Line], int, list[int]]]:
    """(lines, speakers, speaker of each line or -1) from at most ``most`` lines: those of the recordings of the least hash, in order.

    The speaker of a line is known where the screenplay of its episode has its words and gives them to one speaker; labels tell nothing here. A piece begins
    at a line with a label.
    """
    sample = lines.orderBy(F.xxhash64("orig_index"), "orig_index", "t_ms", "chunk_index", "line_no").limit(most)
    words = F.regexp_replace("text", NOT_HAN, "")
    said = script.select(F.col("episode").alias("e"), F.col("line").alias("l"), _name("speaker").alias("s")).where("s <> ''")
    known = said.groupBy("e", "l").agg(F.min("s").alias("gold"), F.max("s").alias("other")).where("gold = other").drop("other")
    rows = sample.join(known, (F.col("episode") == F.col("e")) & (words == F.col("l")), "left").drop("e", "l").toPandas()
    rows["label"] = rows["label"].map(tuple)
    rows = rows.sort_values(["orig_index", "t_ms", "chunk_index", "line_no"]).drop_duplicates(["orig_index", *_SAME])
    out = []
    for _, g in rows.groupby("orig_index"):
        at = [i for i, x in enumerate(g["label"]) if len(x)]
        while at:
            lo = at[0]
            k = g.iloc[lo : lo + piece]
            gold = [x if isinstance(x, str) else None for x in k["gold"]]
            got, names = _as_lines(*[k[c].tolist() for c in _SAME[:5]], {x for x in gold if x})
            out.append((got, len(names), [names.index(x) if x else -1 for x in gold]))
            at = [i for i in at if i >= lo + piece]
    return out


def fit_turn_model(lines: DataFrame, script: DataFrame, most: int = TRAIN_LINES) -> TurnModel:
    """Fit the model to the screenplays of a sample of at most ``most`` lines; where it has none, the model of DEFAULT_WEIGHTS."""
    pieces = [x for x in training_pieces(lines, script, most) if any(y >= 0 for y in x[2])]
    return TurnModel().fit(pieces) if pieces else TurnModel(np.array(DEFAULT_WEIGHTS))


#: Weights where there is nothing to fit on (empty tables, no screenplay): a label counts, a turn without one goes on.
DEFAULT_WEIGHTS = (6.0, 4.0, -8.0, -8.0, 2.0, -8.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)


def speaker_turns(
    chunks: DataFrame, aliases: DataFrame, script: DataFrame | None = None, model: TurnModel | None = None, section_s: int = SECTION_S, section_lines: int = SECTION_LINES,
    series_letters: int = SERIES_LETTERS,
) -> DataFrame:
    """Clean turns in order of time: orig_index, start_ms, speaker, text, lines.

    Lines are stripped of stamps, labels, hesitations and sound annotations; label variants (spacing, width, case, numbers, side
    marks, one wrong character) are resolved against the cast of the series. A semi-Markov conditional model chooses the best sequence of whole turns:
    ``model``, or one that is fitted to the screenplays of a bounded sample of lines. Lines of
    which nothing is left are scored like others, and left out when a turn is put together: they make no turn and end none; neighbouring turns of one speaker are one.

    Recordings are decoded in sections of ``section_s`` seconds and at most ``section_lines`` lines, which stream through a task in order; whoever spoke last before a section is carried into it, and
    turns are joined across its border, so a recording of any length is no hot task.

    Defined results: null orig_index does not count; null chunk_index is 0; null or empty text and items give no
    lines; a chunk delivered again counts in its latest version; of equal lines of one time the k-th of one chunk and the k-th of another are one line, those of one chunk all
    count; lines before the first label of a recording have a null
    speaker; a recording without a cast has one turn of null speaker; a line without a time of its own has the time of the line before it (else the
    next one's, else the start of its chunk); empty tables give no rows. Columns besides the tables' own are ignored.
    """
    lines = transcript_lines(chunks, aliases, series_letters)
    if model is None:
        lines = cut(lines)
        model = fit_turn_model(lines, script) if script is not None else TurnModel(np.array(DEFAULT_WEIGHTS))
    weights = model.w
    names_out = ["orig_index", "section", "seq", "start_ms", "speaker", "text", "lines", "last", "first", "second", "final", "turns"]

    def turns_of(key: tuple, rows: tuple, names: list[str], got: list[tuple[int, int, int]]) -> list[tuple]:
        turns: list[list] = []
        last = None
        for lo, hi, s in got:
            who = names[s] if s < len(names) else None
            last = who or last
            left = [k for k in rows[lo:hi] if k.text]
            if not left:
                continue
            if turns and turns[-1][1] == who:
                turns[-1][2] += left
            else:
                turns.append([round(left[0].time * 1000), who, left])
        out = [(*key, i, at, who, "\n".join(k.text for k in left), len(left), None, None, None, None, None) for i, (at, who, left) in enumerate(turns)]
        # One more row a section: who spoke last, the speakers of its first two turns and its last one, its number of turns.
        spoke = [x[1] for x in turns]
        return [*out, (*key, -1, None, None, None, None, last, *(spoke + [None] * 2)[:2], spoke[-1] if spoke else None, len(turns))]

    def decode(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = TurnModel(weights)
        sections: list[tuple[tuple, list[Line], list[str]]] = []
        key, rows, part = None, [], 0

        def close() -> None:
            if rows:
                sections.append(((key[0], key[1] * (1 << 24) + part), *_as_lines(*zip(*rows))))

        def done() -> pd.DataFrame:
            got = m.decode_many([(x, len(names)) for _, x, names in sections])
            out = [r for (k, x, names), turns in zip(sections, got) for r in turns_of(k, x, names, turns)]
            sections.clear()
            pdf = pd.DataFrame(out, columns=names_out)
            return pdf.astype({"start_ms": "Int64", "lines": "Int32", "turns": "Int32"})

        for pdf in it:
            for o, h, *row in zip(*[pdf[c].tolist() for c in ("orig_index", "hour", "t_ms", "label", "exact", "text", "spoken")]):
                if (o, h) != key:
                    close()
                    key, rows, part = (o, h), [], 0
                elif len(rows) >= section_lines:
                    close()
                    rows, part = [], part + 1
                rows.append(row)
            if sum(len(x) for _, x, _ in sections) >= 8192:
                yield done()
        close()
        yield done()

    ddl = "orig_index int, section long, seq int, start_ms long, speaker string, text string, lines int, last string, first string, second string, final string, turns int"
    hours = spread(lines.withColumn("hour", F.floor(F.col("t_ms") / (1000 * section_s))), ["orig_index", "hour"])
    once = hours.groupBy("orig_index", "hour", *_SAME).agg(F.min(F.struct("chunk_index", "line_no")).alias("at")).sortWithinPartitions("orig_index", "hour", "t_ms", "at")
    parts = cut(once.select("orig_index", "hour", "t_ms", "label", "exact", "text", "spoken").mapInPandas(decode, ddl))

    # Sections in order: whom a turn without a name of its own goes to, and whether the first turn goes on with the one before it.
    before = Window.partitionBy("orig_index").orderBy("section").rowsBetween(Window.unboundedPreceding, -1)
    ends = parts.where("seq = -1").withColumn("carried", F.last("last", ignorenulls=True).over(before))
    some, here = F.col("turns") > 0, lambda n: F.struct(F.col("section").alias("section"), F.lit(n).cast("int").alias("seq") if isinstance(n, int) else n.alias("seq"))
    ends = ends.withColumn("prior", F.last(F.when(some, F.struct(F.coalesce("final", "carried").alias("x"))), ignorenulls=True).over(before))
    goes_on = some & F.col("prior").isNotNull() & F.col("prior.x").eqNullSafe(F.coalesce("first", "carried"))
    # The second turn is the first one's, where that turns out to be of the same speaker.
    same = (F.col("turns") > 1) & F.col("first").isNull() & F.col("second").eqNullSafe(F.col("carried"))
    ends = ends.withColumn("goes_on", goes_on).withColumn("same", same)
    first_only = F.col("turns") == F.when(F.col("same"), 2).otherwise(1)
    ends = ends.withColumn("head", F.when(some & ~first_only, here(F.col("turns") - 1)).when(first_only & ~F.col("goes_on"), here(0)))
    ends = ends.withColumn("own", F.when(F.col("goes_on"), F.last("head", ignorenulls=True).over(before)).otherwise(here(0)))
    turns = parts.where("seq >= 0").select("orig_index", "section", "seq", "start_ms", "speaker", "text", "lines")
    turns = turns.join(ends.select("orig_index", "section", "carried", "own", "same").hint("merge"), ["orig_index", "section"])
    begins = (F.col("seq") == 0) | ((F.col("seq") == 1) & F.col("same"))
    turns = turns.withColumn("speaker", F.coalesce("speaker", "carried")).withColumn("own", F.when(begins, F.col("own")).otherwise(F.struct("section", "seq")))
    piece = F.struct("section", "seq", "start_ms", "text", "lines")
    whole = turns.groupBy("orig_index", "own").agg(F.any_value("speaker").alias("speaker"), F.array_sort(F.collect_list(piece)).alias("p"))
    return whole.select(
        "orig_index",
        F.element_at("p", 1)["start_ms"].alias("start_ms"),
        "speaker",
        F.array_join(F.col("p.text"), "\n").alias("text"),
        F.aggregate("p", F.lit(0), lambda a, x: a + x["lines"]).alias("lines"),
    )
