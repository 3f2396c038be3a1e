"""Defective question-answer pairs, with the type of defect.

Copies: every answer is compressed with its question as a zstandard dictionary; what the dictionary
can't explain is what the answer adds.  An exact check on the words follows.
Refusals: a dictionary of refusing phrases by language, sentence by sentence, so that an answer which
goes on to say something isn't one.
Languages: a dictionary of function words labels the messages that are plain to label; from all of
these a table of words by language is counted, which then judges every question and answer.
Truncation: a terminal-context model.  The ends of all messages are counted by context (last mark,
open brackets and fences, list line, length), and so are ends made by cutting the same messages
short; an answer breaks off where the second is the likelier origin of its end.
Both tables have a fixed number of entries whatever the number of messages.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from importlib import resources

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values -----------------------------------------------------------------------------
USER_ROLES = ("user", "human", "prompter", "question", "customer")
ANSWER_ROLES = ("assistant", "bot", "model", "gpt", "ai", "chatbot", "answer")
SYSTEM_ROLES = ("system", "developer")
PLACEHOLDERS = (
    "none", "null", "nil", "nan", "n/a", "na", "tbd", "tba", "todo", "empty", "blank", "undefined", "no response", "no answer",
    "no content", "no reply", "not available", "missing", "keine antwort", "k.a.", "sin respuesta", "pas de réponse", "无", "空", "无回答",
)
FUNCTION_WORDS = {
    "en": "the a an of and to in is are was were that this it for with as on by at from not be has have had but or which when what how why do does can you your about before after than its there into over only both no one two every each they we our i if my her his",
    "de": "der die das und in zu den von mit ist im auf für ein eine einer einem nicht sich dem des auch als an wird sind war bei nach aus wie was warum wer haben wurde wurden bis zum zur über wenn vor noch nur kann man oder ohne neben schon seit um ab durch",
    "fr": "le la les de des du et en un une est à pour dans que qui sur avec au aux ce cette ne pas par plus sont il elle on nous vous pourquoi comment quelle quels mais ou où après avant sans selon été son sa ses dit bref",
    "es": "el la los las de del y en un una es a para que por con se su al lo como más pero no son fue entre sin sobre desde hasta tras qué cómo cuál según todo esta este hay muy cuando dos breve ha",
}
LANGUAGES = ("en", "de", "fr", "es", "zh")
LANGUAGE_NAMES = {
    "en": "english englisch englischer anglais inglés ingles 英文 英语",
    "de": "german deutsch deutscher allemand alemán aleman 德文 德语",
    "fr": "french französisch franzosisch français francais francés frances 法文 法语",
    "es": "spanish spanisch espagnol español espanol castellano 西班牙文 西班牙语",
    "zh": "chinese chinesisch chinois chino mandarin 中文 汉语 华语",
}
YES_NO = {"yes": "en", "ja": "de", "nein": "de", "oui": "fr", "non": "fr", "sí": "es", "是": "zh", "否": "zh"}
INTERJECTIONS = (
    "good question", "great question", "gute frage", "bonne question", "buena pregunta", "好问题", "sure", "of course", "gern", "gerne",
    "natürlich", "bien sûr", "claro", "por supuesto", "sorry", "i'm sorry", "i am sorry", "entschuldigung", "es tut mir leid", "tut mir leid",
    "désolé", "désolée", "je suis désolé", "lo siento", "disculpa", "抱歉", "很抱歉", "对不起", "很遗憾", "当然", "好的", "unfortunately", "thanks", "thank you", "thank you for asking", "thanks for asking", "thank you for your question", "danke für die frage", "danke der nachfrage",
    "merci pour la question", "merci de votre question", "gracias por preguntar", "gracias por la pregunta", "谢谢你的提问", "感谢提问", "谢谢提问", "danke", "merci", "gracias", "谢谢", "apologies", "my apologies", "pardon", "verzeihung", "pardonnez-moi", "perdón", "不好意思",
)
# -----------------------------------------------------------------------------------------------

#: Entries of the table of words by language, as a power of two.
WORD_BITS = 16
#: Share of an answer's bytes that its question doesn't explain, above which it is no copy.
OWN_SHARE = 0.45
#: Bytes that the dictionary has at least; zstandard ignores one of fewer than 8.
DICTIONARY = 32
#: Words that may stand before a copied question ("Your question was:").
LEAD_WORDS = 5
#: Log odds by which the answer's language must be likelier than the question's.
LANGUAGE_ODDS = 3.0
#: Log odds of a whole message against a cut one, below which an end is a break: one in eight messages or fewer is cut.
CUT_ODDS = -2.0

#: Where the dictionary of refusals is.
REFUSALS = "refusals.tsv"


def _phrase(text: str) -> str:
    """A pattern for a phrase of the dictionary; words of scripts without blanks need no bounds."""
    pattern = re.escape(text).replace(r"\ \*\ ", r"\b.{1,80}?\b").replace("\\~", r"\w*").replace("~", r"\w*")
    if re.search(r"[\u3040-\u9fff]", text):
        return pattern
    return (r"\b" if re.match(r"\w", text) else "") + pattern + (r"\b" if re.search(r"[\w~]$", text) else "")


class Refusals:
    """Sentences that decline, from lines of language, kind and phrases, tab-separated.

    A sentence is searched for the longest part of each phrase without a gap first, all at once; only one that has such a part
    meets the pattern."""

    def __init__(self, lines: Iterable[str]) -> None:
        kinds: dict[str, dict[str, list[str]]] = {}
        for line in lines:
            if line.strip() and not line.startswith("#"):
                lang, kind, phrases = line.rstrip("\n").split("\t")
                kinds.setdefault(lang, {})[kind] = phrases.split("|")
        parts, first, never = [], [], []
        either = lambda phrases: "(?:" + "|".join(map(_phrase, phrases)) + ")"
        for k in kinds.values():
            never += k.get("never", [])
            if "whole" in k:
                parts.append(either(k["whole"]))
                first += k["whole"]
            if "decline" in k and "act" in k:
                who = f"{either(k['speaker'])}.{{0,60}}?" if "speaker" in k else ""
                parts.append(f"{who}{either(k['decline'])}.*?{either(k['act'])}")
                first += k["decline"]
        self.pattern, self.never = re.compile("|".join(parts), re.I), re.compile(either(never), re.I)
        self.words = ahocorasick.Automaton()
        for phrase in first:
            part = max((x.strip() for x in re.split(r"[~*]", phrase)), key=len).lower()
            self.words.add_word(f" {part}" if part[0].isascii() and part[0].isalnum() else part, True)
        self.words.make_automaton()

    def search(self, sentence: str) -> bool:
        """Whether a sentence in lower case declines."""
        return next(self.words.iter(" " + sentence.translate(_OPENING)), None) is not None and self.pattern.search(self.never.sub(" ", sentence)) is not None


_REFUSAL = Refusals(resources.files(__package__).joinpath(REFUSALS).read_text("utf-8").splitlines())
_INVISIBLE = regex.compile(r"(?V1)[[\p{Cf}\p{Cc}\p{Co}\p{Cn}]--[\n\t]]")
_OPENING = {ord(c): " " for c in "\"([{¿¡«*_-–—/"}
_QUOTES = {0x2018: "'", 0x2019: "'", 0x201C: '"', 0x201D: '"'}
_MARKS = re.compile(r"[\W_]+")
_SPEAKING = regex.compile(r"[\p{L}\p{N}\p{So}]")
_SENTENCE = re.compile(r"[^.!?。！？\n]+[.!?。！？]*")
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_HAN = re.compile(r"[㐀-鿿]")
_UNIT = re.compile(r"[㐀-鿿]|[^\W_㐀-鿿]+")
_CODE = re.compile(r"```.*?(?:```|$)", re.S)
_OPENERS = re.compile(r"[`(\[{（「“]")
_SIXTH = re.compile(r"(?:[^a-zA-Z]*[a-zA-Z]+){4}")
_URL = re.compile(r"\w+://\S+")
_LIST = re.compile(r"\s*(?:[-*•]|\d{1,3}[.)])\s+\S")
_WORD_SETS = {lang: frozenset(words.split()) for lang, words in FUNCTION_WORDS.items()}
_LANGUAGES_OF = {w: [i for i, known in enumerate(_WORD_SETS.values()) if w in known] for w in frozenset().union(*_WORD_SETS.values())}


def tidy(text: str | None) -> str:
    """Compatibility form without invisible characters, straight quotes, one space between words."""
    text = text or ""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).translate(_QUOTES)
    if not text.isprintable():  # line ends, invisible characters and other white space aren't
        text = _INVISIBLE.sub("", text)
    return " ".join(text.split())


def _blank(seen: str) -> bool:
    if len(seen) > 40:  # no placeholder is as long
        return not _SPEAKING.search(seen)
    seen = seen.lower()
    return not _SPEAKING.search(seen) or seen in PLACEHOLDERS or re.sub(r"^[\W_]+|[\W_]+$", "", seen) in PLACEHOLDERS


def is_blank(text: str | None) -> bool:
    """No answer at all: nothing visible, marks only, or a placeholder."""
    return _blank(tidy(text))


def _refuses(answer: str, question: str) -> bool:
    declined = False
    quoted = question.rstrip(" .!?。！？")
    for sentence in _SENTENCE.findall(answer):
        bare = sentence.strip(" .!?。！？,，:;\"'*")
        if not bare or bare in INTERJECTIONS:
            continue
        if not _REFUSAL.search(sentence):
            return False
        own = sentence.replace(quoted, "", 1) if quoted else sentence
        after = re.split(r"[:：]", own, maxsplit=1)
        if len(after) > 1 and len(_WORD.findall(after[1])) > 2 and not _REFUSAL.search(after[1]):
            return False  # "I can't say it more simply: ..." goes on to answer
        declined = True
    return declined


def is_refusal(answer: str, question: str = "") -> bool:
    """Every sentence declines or is a mere interjection, and at least one declines, however long it is."""
    return _refuses(tidy(answer).lower(), tidy(question).lower())


def own_share(question: str, answer: str) -> float:
    """Share of the answer that remains when it is compressed with its question as the dictionary.

    What is measured is what the answer adds to the compressed size of the question itself, so that a frame and its tables, which
    outweigh a short answer, count on both sides; the question stands behind the answer, for zstandard looks for no match in
    the last bytes, and as often as it takes to fill a dictionary."""
    data, given = answer.encode(), question.encode()
    if not data or not given:
        return 1.0 if data else 0.0
    given *= -(-DICTIONARY // len(given))
    held = zstandard.ZstdCompressionDict(given, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    if len(given) + len(data) > 1 << 17:  # a match may lie as far back as the texts are long
        far = zstandard.ZstdCompressionParameters.from_level(3, window_log=min(30, (2 * len(given) + len(data)).bit_length()), write_content_size=False, write_dict_id=False)
        with_it = zstandard.ZstdCompressor(compression_params=far, dict_data=held)
    else:
        with_it = zstandard.ZstdCompressor(level=3, dict_data=held, write_content_size=False, write_dict_id=False)
    return max(0, len(with_it.compress(data + given)) - len(with_it.compress(given))) / len(data)


def _letters(text: str) -> str:
    return _MARKS.sub("", text)


def _plain(text: str) -> str:
    return _MARKS.sub(" ", text).strip()


def _in_order(words: list[str], of: list[str]) -> bool:
    rest = iter(of)
    return all(w in rest for w in words)


def _says_again(q: str, a: str, lead: list[str]) -> bool:
    """The exact check: no word but those of the question, in its order sentence by sentence, besides a few words before a colon."""
    whole, rest = _letters(q), _letters(a)
    last = _letters((_SENTENCE.findall(q) or [q])[-1])
    if whole in rest:
        left = rest.replace(whole, "")
    elif len(last) >= 6 and last in rest:
        left = rest.replace(last, "")
    elif rest in whole and 2 * len(rest) >= len(whole):
        left = ""
    else:
        left = rest
    if not left or (len(lead) > 1 and left == _letters(lead[0])):
        return True
    asked, asking = _UNIT.findall(q), _UNIT.findall((_SENTENCE.findall(q) or [q])[-1])
    said = [_UNIT.findall(s) for s in set(_SENTENCE.findall(lead[-1]))]
    if not all(_in_order(s, asked) for s in said):
        return False
    return any(2 * sum(map(len, s)) >= len(last) and _in_order(s, asking) for s in said)  # most of what is asked, not of what leads to it


def _copies(q: str, a: str) -> bool:
    asked, given = _plain(q), _plain(a)
    if not asked or not given:
        return False
    lead = re.split(r"[:：]", a, maxsplit=1)
    if len(lead) > 1 and len(_WORD.findall(lead[0])) > LEAD_WORDS:
        lead = [a]
    if own_share(asked, given) > OWN_SHARE and (len(lead) == 1 or own_share(asked, _plain(lead[1])) > OWN_SHARE):
        return False
    return _says_again(q, a, lead)


def is_copy(question: str, answer: str) -> bool:
    """The answer gives the question back and adds nothing of substance.

    Every pair is compressed, question as dictionary, whatever its length; those whose answer the question explains
    meet the exact check of their words."""
    return _copies(tidy(question).lower(), tidy(answer).lower())


def labelled_language(words: list[str], han: int) -> str | None:
    """The language of lower-case words and so many Han characters, where function words leave no doubt."""
    if han > 3 and han > 2 * len(words):
        return "zh"
    hits = [0] * len(_WORD_SETS)
    for w in words:
        for i in _LANGUAGES_OF.get(w, ()):
            hits[i] += 1
    n = max(hits)
    best = hits.index(n)
    second = max(hits[:best] + hits[best + 1 :])
    return LANGUAGES[best] if n >= 3 and n >= 1.7 * second and n >= 0.2 * len(words) else None


def _words(text: str) -> tuple[list[str], int]:
    """(words in lower case, number of Han characters)."""
    han = 0 if text.isascii() else len(_HAN.findall(text))
    return _WORD.findall((_HAN.sub(" ", text) if han else text).lower()), han


@lru_cache(1 << 17)
def _bucket(word: str) -> int:
    return zlib.crc32(word.encode()) & ((1 << WORD_BITS) - 1)


def _prose(text: str) -> str:
    return _URL.sub(" ", _CODE.sub(" ", text))


def language_scores(text: str, table: np.ndarray) -> tuple[np.ndarray, int]:
    """(log likelihood of each language, words judged) of a tidy text.  Han characters speak for zh, four to a word."""
    prose = tidy(_prose(text)) if "`" in text or "://" in text else text
    bare = prose.lower().strip(" .!。！")
    if bare in YES_NO:
        return np.array([0.0 if lang == YES_NO[bare] else -9.0 for lang in LANGUAGES]), 1
    score = np.zeros(len(LANGUAGES))
    words, han = _words(prose)
    if words:
        score += table[[_bucket(w) for w in words]].sum(0)
    if han:
        score[:4] -= 3.0 * han / 4
        score[4] -= 0.1 * han / 4
    return score, len(words) + han // 2


def context(text: str) -> str:
    """How a message ends: last mark, what is left open, kind of line, length."""
    body = text.rstrip()
    last = body[-1:]
    token = body.rsplit(None, 1)[-1] if body else ""
    closers = body.rstrip("\"'»”’)]}*_`")
    before = closers[-1:]
    if not body:
        mark = "nothing"
    elif "://" in token:
        mark = "address"
    elif body.endswith("```"):
        mark = "fence"
    elif last in ".!?。！？…":
        mark = "stop"
    elif unicodedata.category(last) in ("So", "Sk"):
        mark = "sign"
    elif last != before and before and before in ".!?。！？…":
        mark = "stop"
    elif last in ")]}\"'»”’*":
        mark = "closer"
    elif last in ",;:，；：、-–—(":
        mark = "going on"
    else:
        mark = "Han" if _HAN.match(last) else "digit" if last.isdigit() else "letter" if last.isalpha() else "other"
    opened = _OPENERS.search(body) is not None and (body.count("```") % 2 or any(body.count(a) > body.count(b) for a, b in ("()", "[]", "{}", "（）", "「」", "“”")))
    lines = [x for x in body.split("\n") if x.strip()] if "\n" in body else []
    listed = len(lines) > 1 and all(_LIST.match(x) for x in lines)
    words = 9 if body.isascii() and body.count(" ") > 8 and _SIXTH.match(body) else len(_WORD.findall(_HAN.sub(" ", body))) + len(_HAN.findall(body)) // 2
    return f"{mark} {'open' if opened else 'closed'} {'list' if listed else 'plain'} {'word' if words <= 1 else 'few' if words <= 3 else 'many'}"


def cut_short(text: str) -> str | None:
    """The message broken off somewhere in its second half, at a place its own bytes decide; None for messages too short to tell."""
    if len(text) < 24:
        return None
    at = len(text) // 2 + zlib.crc32(text.encode()) % (len(text) // 2 - 2)
    return text[:at]


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts: words by language, and contexts of whole and cut messages."""
    ends: Counter = Counter()
    words = np.zeros((len(LANGUAGES), 1 << WORD_BITS), np.int64)
    for b in batches:
        found: list[list[int]] = [[] for _ in LANGUAGES]
        for text in b.column("content").to_pylist():
            seen = tidy(text)
            if _blank(seen):
                continue
            ends["whole " + context(text)] += 1
            if (cut := cut_short(text)) is not None:
                ends["cut " + context(cut)] += 1
            said, han = _words(_prose(seen))
            if (lang := labelled_language(said, han)) and lang != "zh":
                found[LANGUAGES.index(lang)] += map(_bucket, said)
        for i, buckets in enumerate(found):
            words[i] += np.bincount(buckets, minlength=1 << WORD_BITS)[: 1 << WORD_BITS] if buckets else 0
    lang, bucket = np.nonzero(words)
    yield pa.RecordBatch.from_arrays([
        pa.array(["word"] * len(lang) + ["end"] * len(ends)), pa.array([LANGUAGES[i] for i in lang] + list(ends)),
        pa.array(np.append(bucket, np.zeros(len(ends), np.int64)).astype(np.int32)), pa.array(np.append(words[lang, bucket], list(ends.values())).astype(np.int64)),
    ], ["kind", "label", "bucket", "n"])


class Models:
    """The word table and the odds of contexts, small enough to travel with the function."""

    def __init__(self, words: np.ndarray, odds: dict[str, float]) -> None:
        self.words, self.odds = words, odds

    @classmethod
    def train(cls, messages: DataFrame) -> Models:
        """From all messages; at most 4 * 2**WORD_BITS word counts and some hundred contexts reach the driver."""
        got = messages.select("content").where("content is not null").mapInArrow(_train, "kind string, label string, bucket int, n long").groupBy("kind", "label", "bucket").agg(F.sum("n").alias("n")).toArrow()
        counts = np.full((1 << WORD_BITS, len(LANGUAGES)), 0.05)
        ends: dict[str, Counter] = {"whole": Counter(), "cut": Counter()}
        for kind, label, bucket, n in zip(*(got.column(c).to_pylist() for c in ("kind", "label", "bucket", "n")), strict=True):
            if kind == "word":
                counts[bucket, LANGUAGES.index(label)] += n
            else:
                origin, _, where = label.partition(" ")
                ends[origin][where] += n
        for lang, known in _WORD_SETS.items():
            for w in known:
                counts[_bucket(w), LANGUAGES.index(lang)] += 5
        # how likely each language is given the word; a word never seen says nothing
        counts[:, 4] = 0.05
        seen = counts[:, :4].sum(1) > 0.5
        share = np.log(counts / counts.sum(1, keepdims=True))
        words = np.where(seen[:, None], np.maximum(share, -3.0), 0.0).astype(np.float32)
        words[~seen, 4] = -1.0
        total = {k: sum(c.values()) + 1 for k, c in ends.items()}
        every = set(ends["whole"]) | set(ends["cut"])
        odds = {w: math.log((ends["whole"][w] + 0.5) / total["whole"]) - math.log((ends["cut"][w] + 0.5) / total["cut"]) for w in every}
        return cls(words, odds)

    def truncated(self, answer: str) -> bool:
        where = context(answer)
        return " open " in where or self.odds.get(where, -9.0 if where.startswith("going on") else 0.0) < CUT_ODDS

    def other_language(self, question: str, answer: str) -> bool:
        """Of tidy texts: whether the answer is in another language, which the question doesn't name."""
        asked, given = language_scores(question, self.words), language_scores(answer, self.words)
        if not asked[1] or not given[1]:
            return False
        own, theirs = LANGUAGES[int(asked[0].argmax())], LANGUAGES[int(given[0].argmax())]
        if own == theirs or given[0].max() - given[0][LANGUAGES.index(own)] < LANGUAGE_ODDS:
            return False
        words = set(_WORD.findall(question.lower()))
        return not any(n in words or (_HAN.match(n) and n in question) for n in LANGUAGE_NAMES[theirs].split())

    def defect(self, question: str | None, answer: str | None) -> str | None:
        """The defect of a pair; the first that holds of empty, copied_question, refusal, other_language, truncated."""
        given = tidy(answer)
        if _blank(given):
            return "empty"
        asked = tidy(question)
        q, a = asked.lower(), given.lower()
        if _copies(q, a):
            return "copied_question"
        if _refuses(a, q):
            return "refusal"
        if self.other_language(asked, given):
            return "other_language"
        return "truncated" if self.truncated(answer) else None


def tidy_roles(roles: list[str | None]) -> list[str | None]:
    """user, assistant or system for each message; None for any other role.

    Where roles are absent, user and assistant alternate after an optional system message: the
    nearest named turn decides, and without any, the last message is an answer."""
    known: list[str | None] = []
    absent = []
    for i, role in enumerate(roles):
        name = (role or "").strip().lower()
        if not name:
            absent.append(i)
        known.append("user" if name in USER_ROLES else "assistant" if name in ANSWER_ROLES else "system" if name in SYSTEM_ROLES else None)
    turns = [i for i, k in enumerate(known) if k in ("user", "assistant")]
    for i in absent:
        if turns:
            near = min(turns, key=lambda t: (abs(t - i), t))
            same = (near - i) % 2 == 0
            known[i] = known[near] if same else ("assistant" if known[near] == "user" else "user")
        else:
            known[i] = "assistant" if (len(roles) - 1 - i) % 2 == 0 else "user"
        if i == 0 and known[0] == "assistant":
            known[0] = "system"
    return known


def pairs_of(messages: list[dict] | None) -> Iterator[tuple[int, str | None, str | None]]:
    """(position of the question, question, answer) of a conversation; the answer is None where none follows."""
    messages = messages or []
    roles = tidy_roles([m and m.get("role") for m in messages])
    for i, role in enumerate(roles):
        if role == "user":
            answered = i + 1 < len(messages) and roles[i + 1] == "assistant"
            yield i, (messages[i] or {}).get("content"), (messages[i + 1] or {}).get("content") if answered else None


_FOUND = "table_name string, record_no long, msg_pos int, defect string"


def _finder(models):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Models(*models.value)
        for b in batches:
            out = []
            for table, record, messages in zip(b.column("table_name").to_pylist(), b.column("record_no").to_pylist(), b.column("messages").to_pylist(), strict=True):
                if not messages:
                    out.append((table, record, -1, "empty"))
                    continue
                for at, question, answer in pairs_of(messages):
                    if defect := judge.defect(question, answer):
                        out.append((table, record, at, defect))
            columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int32(), pa.string()), strict=True)], ["table_name", "record_no", "msg_pos", "defect"])

    return find


def defective_pairs(conversations: DataFrame) -> DataFrame:
    """(table_name, record_no, msg_pos, defect) of every defective pair.

    conversations: table_name, record_no and messages (role, content); other columns are ignored.  A
    pair is a user's message, at msg_pos from 0, and the answer after it; a user's message that no
    answer follows is `empty`, as is an answer of blanks, invisible characters or a placeholder.  A
    record whose messages are null or an empty array is one case, at -1.  Null messages count as
    messages without role and content.  Repeated records are judged each for itself; an empty table
    gives an empty result.  The models are counted from all messages given, in one pass; judging is a
    second pass without a shuffle.
    """
    rows = conversations.select("table_name", "record_no", F.transform("messages", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))
    models = Models.train(rows.select(F.explode("messages").alias("m")).select("m.content"))
    sent = conversations.sparkSession.sparkContext.broadcast((models.words, models.odds))
    return rows.mapInArrow(_finder(sent), _FOUND)
