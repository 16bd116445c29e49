"""Problem 6: broken prompt and response pairs.

A multi-label linear classifier over hashed n-grams and pair features decides on every record. It is trained on a bounded sample of
the corpus' own exchanges, each also turned into synthetic defects (emptied, copied, swapped with prose of another language,
refused, cut); sampled exchanges that a first fit takes for defective are left out of a second one. Each defect's threshold is
calibrated on a held-out part. Of several defects above their thresholds the one that exceeds its own by most is reported.

The pair features say what an answer looks like beside its question (lengths, shared words, languages, open fences and brackets, how
the text ends, whether it holds phrases that decline); none of them decides by itself. N-grams are those of the whole answer's prose,
with its end marked.

Defined results: a record without an assistant turn, with a null or blank answer is ``empty`` (also where the question is missing);
records whose messages are null count as without assistant turn; a record has at most one defect; repeated records are judged each;
a table without any exchange to learn from is judged by a model fitted on the fixed texts alone.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.language import language
from corpusmill.llm.syntax import parses_python
from corpusmill.runtime import map_columns

DEFECTS = ("empty", "copies_question", "refusal", "other_language", "truncated")
#: Rows of the training sample (smallest hashes of record_id), its share held out for calibration, tasks that prepare it, size of the hashed space.
TRAIN_ROWS = 2000
HELD_OUT = 0.25
TRAIN_TASKS = 8
BUCKETS = 1 << 16
#: Shares of the held-out exchanges and of the held-out synthetic defects that may be odd ones; a threshold lies halfway between the others.
ODD_SOUND = 0.01
ODD = 0.02
FENCE = re.compile(r"^[ \t]*(?:```|~~~)[^\n]*$", re.M)
BLOCK = re.compile(r"(?:```|~~~)[^\n]*\n?(.*?)(?:```|~~~|\Z)", re.S)
QUOTE = re.compile(r"^\s*>.*$", re.M)
INLINE = re.compile(r"`[^`\n]*`|\b\w+_\w+\b|https?://\S+")
NOISE = re.compile(r"[\W_]+")
# Marks that stand for no answer.
FILLERS = frozenset(("", "none", "null", "nil", "na", "nan", "noanswer", "empty", "tbd", "todo", "undefined", "blank"))
# Phrases that decline, in the corpus languages.
REFUSALS = {
    "en": ["I'm sorry, but I can't help with that.", "I cannot assist with this request.", "I am unable to provide this.", "I won't be able to answer this question.", "Sorry, I'd rather not do that.", "I must decline this request.", "As an AI language model, I cannot write this code.", "Unfortunately, I can't provide an implementation.", "I can't do that for you, please ask a professional.", "It is not possible for me to help here.", "I don't feel comfortable producing this, therefore I will leave it out.", "I would prefer not to work on that."],
    "de": ["Es tut mir leid, aber dabei kann ich nicht helfen.", "Diese Anfrage muss ich leider ablehnen.", "Als Sprachmodell darf ich das nicht schreiben.", "Das kann ich leider nicht beantworten.", "Dazu möchte ich nichts sagen."],
    "es": ["Lo siento, pero no puedo ayudarte con esa petición.", "No me es posible responder a esta pregunta.", "Como modelo de lenguaje no puedo escribir este código.", "Debo rechazar esta solicitud."],
    "fr": ["Désolé, je ne peux pas vous aider pour cette demande.", "Je ne suis pas en mesure de répondre à cette question.", "En tant que modèle de langage, je ne peux pas écrire ce code.", "Je dois refuser cette demande."],
    "ko": ["죄송하지만 그 요청은 도와드릴 수 없습니다.", "해당 질문에는 답변하지 않겠습니다.", "저는 언어 모델이라서 이 코드를 작성해 드리기 어렵습니다.", "그 내용은 답변드릴 수 없습니다."],
    "ja": ["申し訳ありませんが、そのご依頼にはお応えできません。", "このコードを書くことはお断りいたします。", "その質問にはお答えできません。", "言語モデルのため、このコードは書けません。"],
    "zh": ["抱歉，我无法帮助您完成这个请求。", "很抱歉，我不能回答这个问题。", "作为语言模型，我不能编写这段代码。", "我必须拒绝这个请求。"],
}
# What may come with a refusal.
REASONS = {
    "en": ["This topic touches on matters that I have to leave to others.", "The rules that I follow don't leave room for it.", "A colleague or the documentation will know more about this.", "I hope that you find what you need elsewhere."],
    "de": ["Dieses Thema muss ich anderen überlassen.", "Meine Regeln lassen das nicht zu.", "Bitte wenden Sie sich an eine Fachperson."],
    "es": ["Es un tema que debo dejar a otras personas.", "Mis normas no lo permiten.", "Le recomiendo consultar a un especialista."],
    "fr": ["C'est un sujet que je dois laisser à d'autres.", "Mes règles ne le permettent pas.", "Veuillez consulter un spécialiste."],
    "ko": ["이 주제는 제가 다룰 수 있는 범위를 벗어납니다.", "전문가에게 문의해 주세요.", "양해 부탁드립니다."],
    "ja": ["この話題は私の扱える範囲を超えています。", "専門家にご相談ください。", "ご理解をお願いいたします。"],
    "zh": ["这个话题超出了我可以处理的范围。", "请咨询专业人士。", "感谢您的理解。"],
}
# Sound answers in each corpus language, so that there is foreign prose where the sample has only one language.
FOREIGN = {
    "en": ["The function returns the sorted list and leaves the input as it was.", "You can use a dictionary for this, because the keys are unique and the order does not matter."],
    "de": ["Die Funktion gibt die sortierte Liste zurück und lässt die Eingabe unverändert.", "Dafür kann man ein Wörterbuch verwenden, weil die Schlüssel eindeutig sind und die Reihenfolge nicht wichtig ist."],
    "es": ["La función devuelve la lista ordenada y no cambia los datos de entrada.", "Para esto se puede usar un diccionario, porque las claves son únicas y el orden no importa."],
    "fr": ["La fonction renvoie la liste triée et ne modifie pas les données en entrée.", "On peut utiliser un dictionnaire pour cela, parce que les clés sont uniques et que l'ordre ne compte pas."],
    "ko": ["이 함수는 정렬된 목록을 반환하고 입력은 그대로 둡니다.", "키가 고유하고 순서는 중요하지 않으므로 사전을 사용하면 됩니다."],
    "ja": ["この関数は並べ替えたリストを返し、入力は変更しません。", "キーは一意で順序は関係ないので、辞書を使うことができます。"],
    "zh": ["这个函数返回排序后的列表，并且不会修改输入。", "因为键是唯一的，而且顺序并不重要，所以可以使用字典。"],
}
# Parts of phrases that decline, in scripts with and without spaces, and what each of the former holds.
DECLINES_EAST = re.compile(
    r"(?:드릴|할|도울|줄) 수 없|하지 않겠|어렵습니다|거절|거부|불가능|언어 모델"
    r"|できません|できかね|お断り|お応えでき|お答えでき|書けません|控えさせ|言語モデル|いたしかね"
    r"|无法(?:帮|回答|提供|协助|完成|编写|满足)|不能(?:帮|回答|提供|协助|编写|满足)|拒绝|作为(?:一个)?(?:人工智能|语言模型)|不便"
)
DECLINE_WORDS = ("can't", "can’t", "not", "n't", "n’t", "declin", "refus", "pass on", "unable", "rather", "as a", "against my", "nicht", "keine", "ablehn", "sprachmodell", "verweiger", "no ", "rechaza", "modelo", "prefiero", "ne ", "je dois", "modèle")
DECLINES = re.compile(
    r"(?i)\b(?:can(?:no|['’])t|can not|unable to|not able to|won['’]t be able|will not|won['’]t|could ?n['’]t|not going to|not (?:in a position|comfortable|allowed|possible for me))\b.{0,60}?\b(?:help|assist|provide|answer|write|review|do|give|comply|fulfil|share|create|support|discuss|produce|complete|this|that|here)\b"
    r"|\b(?:must|have to|need to|going to)\s+(?:\w+\s+)?(?:decline|refuse|pass on)\b|\b(?:decline|refuse) (?:to|this|that)\b|\brather not\b|\bas an? (?:ai )?(?:large )?(?:language model|ai\b|assistant)|\bagainst my\b|\bnot something i (?:can|will)\b"
    r"|\bkann ich (?:\w+ ){0,3}(?:nicht|keine)\b|\bablehnen\b|\bals sprachmodell\b|\bdarf ich (?:\w+ ){0,3}nicht\b|\bmöchte ich (?:\w+ ){0,3}(?:nicht|nichts|keine)\b|\bnicht (?:helfen|beantworten|weiterhelfen)\b|\bverweiger"
    r"|\bno (?:puedo|podré|me es posible|estoy en condiciones|voy a poder)\b|\b(?:rechazar|declinar)\b|\bcomo modelo de lenguaje\b|\bprefiero no\b"
    r"|\bje (?:ne (?:peux|suis|pourrai)|dois (?:refuser|décliner))\b|\brefuser\b|\ben tant que modèle\b|\bje préfère ne pas\b",
    re.S,
)
# Names of the corpus languages in those languages.
LANGUAGE_NAMES = {
    "en": "english|englisch|auf englisch|inglés|anglais|영어|英語|英语|英文",
    "de": "german|deutsch|alemán|allemand|독일어|ドイツ語|德语|德文",
    "es": "spanish|spanisch|español|castellano|espagnol|스페인어|スペイン語|西班牙语",
    "fr": "french|französisch|francés|français|프랑스어|フランス語|法语|法文",
    "ko": "korean|koreanisch|coreano|coréen|한국어|한글|韓国語|韩语|韩文",
    "ja": "japanese|japanisch|japonés|japonais|일본어|日本語|日语|日文",
    "zh": "chinese|chinesisch|mandarin|chino|chinois|중국어|中国語|中文|汉语",
}
ASKED = re.compile("(?i)" + "|".join(f"(?P<{k}>{v})" for k, v in LANGUAGE_NAMES.items()))
SENTENCE_END = re.compile(r"[.!?。！？…][\"'”’»)\]*_`」』]*$|^\s*[-*]?\s*`[^`\n]+`\s*$")


def prose(text: str) -> str:
    """A text without fenced code, quoted lines and inline code."""
    if "```" in text or "~~~" in text:
        text = BLOCK.sub("\n", text)
    if ">" in text:
        text = QUOTE.sub("", text)
    return INLINE.sub(" ", text) if "`" in text or "_" in text or "://" in text else text


def plain(text: str) -> str:
    return NOISE.sub("", text).casefold()


def exchange(messages: list[dict] | None) -> tuple[str | None, str | None, bool]:
    """(last question before the last answer, last answer, is there an assistant turn)."""
    question = answer = None
    there = False
    pending = None
    for m in messages or []:
        if not m:
            continue
        if m["role"] == "user":
            pending = m["content"]
        elif m["role"] == "assistant":
            there, answer, question = True, m["content"], pending
    return (question if there else pending), answer, there


def units(question: str) -> list[str]:
    """What counts as the question: all of it, its prose, its first line, its first sentence line with and without code."""
    lines = [x for x in question.split("\n") if x.strip()]
    return [u for u in dict.fromkeys(plain(x) for x in (question, BLOCK.sub("\n", question), FENCE.sub("", question), lines[0] if lines else "")) if u]


def left_over(question: str, answer: str) -> float:
    """Share of the answer's letters and digits that is left without the question, all or its first line, however often it is repeated."""
    a = plain(re.sub(r"(?im)^\s*(?:you asked|question|your question|q|frage|pregunta|question posée|질문|質問|问题)\s*[:：]\s*", "", FENCE.sub("", answer)))
    if len(a) < 8:
        return 1.0
    return min([len(a.replace(u, "")) / len(a) for u in units(question) if len(u) >= 8], default=1.0)


def asked_languages(question: str) -> set[str]:
    return {k for m in ASKED.finditer(question) for k, v in m.groupdict().items() if v}


def broken_code(answer: str) -> bool:
    """Whether the last closed block breaks off: it does not parse, but its beginning does."""
    blocks = re.findall(r"```(?:python|py)?[ \t]*\n(.*?)```", answer, re.S)
    if not blocks or not re.search(r"^\s*(?:def|class|import|from)\b", blocks[-1], re.M):
        return False
    return not parses_python(blocks[-1])


def declines(text: str) -> bool:
    low = text.lower()
    return any(w in low for w in DECLINE_WORDS) and bool(DECLINES.search(text)) or not text.isascii() and max(text) >= "\u1100" and bool(DECLINES_EAST.search(text))


# ---------------------------------------------------------------------------------------------------------------- features
#: Feature numbers below this are pair features, each a row of ``PAIR_FEATURES``.
DENSE = 1024
ENDS = {**dict.fromkeys(".!?。！？…", "stop"), **dict.fromkeys(":;,，、：；", "pause"), **dict.fromkeys(")]}）」』】", "bracket"), **dict.fromkeys("\"'”’»", "quote"), "`": "tick"}
STOPS = re.compile(r"[.!?。！？…](?=\s|$|[\"'”’»)\]*_`」』])|[。！？]")
WORDS = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*")


def _binned(n: float, edges: tuple) -> int:
    return sum(n >= e for e in edges)


def pair_features(question: str | None, answer: str | None, there: bool) -> tuple[list[str], list[str]]:
    """(names of the pair features that hold, words of the answer's prose, or all its letters and digits where they are few)."""
    if not there:
        return ["no turn"], []
    a = (answer or "").strip()
    fenced = "```" in a or "~~~" in a
    fences = FENCE.findall(a) if fenced else []
    body = FENCE.sub("", a) if fenced else a
    core = plain(body)
    on = [f"letters {_binned(len(core), (1, 4, 12, 40, 120, 400))}", f"fences {min(len(fences), 4)}"]
    if len(core) <= 12 and "`" not in body:
        on.append("short")
        if not core:
            return [*on, "nothing"], []
        if core in FILLERS:
            return [*on, "filler"], [core]
    said = prose(a)
    low = said.lower()
    found = WORDS.findall(low)
    if len(fences) % 2:
        on.append("open fence")
    last = a.rsplit("\n", 1)[-1].strip()
    closed = last.startswith(("```", "~~~")) and len(fences) % 2 == 0
    bulk = _binned(len(found), (1, 4, 12))
    on.append(f"prose {bulk}")
    east = any(c >= "\u1100" for c in low[-1:] + low[len(low) // 2 :][:1])
    if closed:
        on.append("ends in code")
        if broken_code(a):
            on.append("code breaks off")
    else:
        end = ENDS.get(a[-1]) or ("letter" if a[-1].isalpha() else "digit" if a[-1].isdigit() else "other")
        stop = bool(SENTENCE_END.search(last))
        on.append("stops" if stop else f"end {end} {bulk}{' east' if east else ''}")
        if not stop:
            tail = said.strip().rsplit("\n", 1)[-1]
            after = max((m.end() for m in STOPS.finditer(tail)), default=0)
            rest = tail[after:]
            on.append(f"after stop {_binned(len(WORDS.findall(rest)), (1, 2, 6))} {end}")
            if after or said.strip().count("\n"):
                on.append(f"more before {end}")
        if re.fullmatch(r"(?:\d+[.)]|[-*•])", last):
            on.append("bare mark")
        if a.count("`") % 2 and not fenced or last.count("`") % 2:
            on.append("open tick")
        if len(re.findall(r"[(（]", last)) > len(re.findall(r"[)）]", last)):
            on.append("open bracket")
    if declines(said):
        sentences = [x for x in STOPS.split(said) if len(plain(x)) >= 4]
        others = sum(not declines(x) for x in sentences)
        on += [f"declines {'code' if fenced else 'prose'} {_binned(others, (1, 2, 3, 5))}", f"declining share {_binned((len(sentences) - others) / max(1, len(sentences)), (0.1, 0.3, 0.5, 0.9))} {'code' if fenced else 'prose'}"]
    if question:
        asked = prose(question)
        q_found = WORDS.findall(asked.lower())
        q = language(asked, found=q_found)
        spoken = language(said, found=found) if sum(map(len, found)) >= 8 else None
        if not q or not spoken:
            on.append(f"language unclear {bulk}")
        else:
            on.append("same language" if q == spoken else "language asked for" if spoken in asked_languages(question) else f"another language {_binned(sum(map(len, found)), (12, 30, 80))}")
        known = set(q_found)
        share = sum(w in known for w in found) / len(found) if found else 0.0
        on.append(f"shared {_binned(share, (0.2, 0.5, 0.8, 0.95))}")
        left = left_over(question, a) if share >= 0.7 or not found else 1.0
        on.append(f"left over {_binned(left, (0.001, 0.05, 0.3))}")
        if QUOTE.search(a):
            on.append("quotes")
    return on, found


@lru_cache(1 << 18)
def _hash(s: str) -> int:
    return zlib.crc32(s.encode("utf-8", "surrogatepass"))


def features(question: str | None, answer: str | None, there: bool) -> list[int]:
    """Numbers of the active features, without repetition: pair features hashed below ``DENSE``, n-grams above."""
    on, found = pair_features(question, answer, there)
    out = {0, *(_hash(x) % (DENSE - 1) + 1 for x in on)}
    space = BUCKETS - DENSE
    if found:
        numbers = list(map(_hash, found))
        out.update(h % space + DENSE for h in numbers)
        out.update((31 * x + y) % space + DENSE for x, y in zip(numbers, numbers[1:]))
        out.update((h + 7) % space + DENSE for h in numbers[-2:])
        for w in found:
            if w[0] >= "\u1100":  # scripts without spaces, and endings that hang on words: pairs of letters
                out.update((65599 * ord(x) + ord(y)) % space + DENSE for x, y in zip(w, w[1:]))
    return sorted(out)


class Rows:
    """Rows of features one behind the other, with their weights: 1 for pair features; the n-grams of a row share a length of one, so that
    they weigh together no more than a few pair features."""

    def __init__(self, rows: list[list[int]]) -> None:
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.flat = np.concatenate([np.array(r, np.int64) for r in rows]) if rows else np.array([], np.int64)
        grams = self.flat >= DENSE
        length = np.repeat(np.add.reduceat(grams, self.ends - self.sizes).clip(1), self.sizes) if rows else np.array([], np.int64)
        self.scale = np.where(grams, 1.0 / np.sqrt(length), 1.0).astype(np.float32)

    def margins(self, weights: np.ndarray) -> np.ndarray:
        """Sums of the rows' weighted weights."""
        if not len(self.sizes):
            return np.zeros((0, weights.shape[1]), np.float32)
        return np.add.reduceat(weights[self.flat] * self.scale[:, None], self.ends - self.sizes, axis=0)

    def take(self, at: np.ndarray) -> Rows:
        """Some of the rows."""
        out = object.__new__(Rows)
        out.sizes = self.sizes[at]
        out.ends = np.cumsum(out.sizes)
        where = np.repeat(self.ends[at] - out.ends, out.sizes) + np.arange(out.sizes.sum())
        out.flat, out.scale = self.flat[where], self.scale[where]
        return out


# ---------------------------------------------------------------------------------------------------------------- training
def _rng(*parts) -> np.random.Generator:
    return np.random.default_rng(zlib.crc32(repr(parts).encode("utf-8", "surrogatepass")))


def corrupt(kind: str, question: str, answer: str, others: dict[str, list[str]], seed: int) -> str | None:
    """A synthetic defect of one kind, or None where the pair doesn't lend itself to it."""
    rng = _rng(kind, seed)
    if kind == "empty":
        forms = ["", " \n", "```python\n```", "...", "-", "```\n\n```", "**", "# ", *sorted(FILLERS), "N/A", "None.", "(empty)", "[no answer]", "<blank>", "TODO", "TBD.", "n/a."]
        return forms[rng.integers(len(forms))]
    if kind == "copies_question":
        first = question.strip().split("\n")[0]
        return (question, question.upper(), f'"{question.strip()}"', first, f"{first}\n{first}", first.rstrip("?.!。？"), f"> {first}", f"**{first}**", question.replace("`", ""), f"Question: {first}", f"{question.strip()} {question.strip()}")[rng.integers(11)]
    if kind == "refusal":
        lang = language(prose(question)) or "en"
        said = [REFUSALS[lang][i] for i in rng.permutation(len(REFUSALS[lang]))[: rng.integers(1, 4)]]
        said += [REASONS[lang][i] for i in rng.permutation(len(REASONS[lang]))[: rng.integers(0, 3)]]
        if rng.random() < 0.1:
            said *= int(rng.integers(2, 8))
        return ("", "Thanks for asking. ", "You asked about this function. ")[rng.integers(3)] + " ".join(said) + ("", " Is there anything else?")[rng.integers(2)]
    if kind == "other_language":
        own = language(prose(question))
        foreign = sorted(k for k in others if k != own and others[k])
        if own is None or not foreign or asked_languages(question):
            return None
        pool = others[foreign[rng.integers(len(foreign))]]
        return pool[rng.integers(len(pool))]
    text = answer.rstrip()
    inner = [i for i in range(max(8, len(text) // 4), len(text) - 1) if text[i - 1].isalnum() and text[i].isalnum() or text[i - 1] in " (,`" and text[i].isalnum()]
    if not inner:
        return None
    cut = text[: inner[rng.integers(len(inner))]].rstrip()
    form = rng.random()
    if "```" not in cut and form < 0.3:  # inside a list, a bracket or inline code
        lines = [x for x in text.split("\n") if x.strip()][: int(rng.integers(1, 6))]
        return (cut + " (", cut + " `", "\n".join(f"{n}. {x}" for n, x in enumerate(lines, 1)) + f"\n{len(lines) + 1}.", "\n".join(f"- {x}" for x in lines) + "\n-")[int(form * 13.3) % 4]
    return cut + (" (", ",")[form > 0.95] if form > 0.9 and len(FENCE.findall(cut)) % 2 == 0 else cut


class Classifier:
    """One logistic regression per defect over shared features, with calibrated thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray) -> None:
        self.weights, self.thresholds = weights, thresholds

    def excess(self, rows: list[list[int]]) -> np.ndarray:
        return Rows(rows).margins(self.weights) - self.thresholds

    def defects(self, rows: list[list[int]]) -> list[str | None]:
        """The defect of each row of features, or None."""
        over = self.excess(rows)
        best = over.argmax(1) if len(over) else []
        return [DEFECTS[k] if over[i, k] >= 0 else None for i, k in enumerate(best)]


Example = tuple[list[int], int, bool]


def examples(records: list[tuple[int, list[dict] | None]]) -> list[Example]:
    """(features, number of the defect or -1, is held out) of sampled exchanges and of their synthetic defects."""
    sound = []
    for i, messages in records:
        q, a, there = exchange(messages)
        if q and q.strip() and a and a.strip():
            sound.append((i, q, a))
    others = {k: list(v) for k, v in FOREIGN.items()}
    for _, q, a in sound:
        lang = language(prose(a))
        if lang and lang == language(prose(q)):
            others.setdefault(lang, []).append(a)
    out: list[Example] = []
    for i, q, a in sound:
        held = _rng("fold", i).random() < HELD_OUT
        out.append((features(q, a, True), -1, held))
        for k, kind in enumerate(DEFECTS):
            bad = corrupt(kind, q, a, others, i)
            if bad is not None:
                out.append((features(q, bad, True), k, held))
        if _rng("turn", i).random() < 0.1:
            out.append((features(q, None, _rng("null", i).random() < 0.5), 0, held))
    return out


def fixed_records() -> list[tuple[int, list[dict]]]:
    """Exchanges of the fixed texts, so that small tables and tables of one language have something to learn from."""
    asks = {
        "en": "How does this function sort the list of results?", "de": "Wie sortiert diese Funktion die Liste der Ergebnisse?", "es": "¿Cómo ordena esta función la lista de resultados?", "fr": "Comment cette fonction trie-t-elle la liste des résultats ?",
        "ko": "이 함수는 결과 목록을 어떻게 정렬하나요?", "ja": "この関数は結果のリストをどのように並べ替えますか?", "zh": "这个函数是怎样对结果列表排序的？",
    }
    code = "```python\ndef f(rows):\n    return sorted(rows)\n```"
    forms = ("{a}", "{a} {b}", "{c}\n\n{a}", "{a}\n\n{c}", "1. {a}\n2. {b}", "{c}", "`f(37)`", "42", "O(n log n)", "{b}\n\n{c}\n\n{a}")
    out = []
    for n, (lang, ask) in enumerate(asks.items()):
        for m, form in enumerate(forms * 2):
            q = ask if m < len(forms) else f"{ask}\n\n{code}"
            out.append((-1000 * n - m - 1, [{"role": "user", "content": q}, {"role": "assistant", "content": form.format(a=FOREIGN[lang][m % 2], b=FOREIGN[lang][1 - m % 2], c=code)}]))
    return out


def _descend(rows: Rows, y: np.ndarray, epochs: int = 8, batch: int = 512, rate: float = 0.3, l2: float = 1e-5) -> np.ndarray:
    """Adagrad on the logistic loss over batches in a fixed order."""
    weights = np.zeros((BUCKETS, len(DEFECTS)), np.float32)
    squares = np.full_like(weights, 1e-4)
    for epoch in range(epochs):
        order = _rng("epoch", epoch).permutation(len(rows.sizes))
        for at in range(0, len(order), batch):
            part = rows.take(order[at : at + batch])
            slope = 1 / (1 + np.exp(-np.clip(part.margins(weights), -30, 30))) - y[order[at : at + batch]]
            each = np.repeat(slope, part.sizes, axis=0) * part.scale[:, None]
            seen = np.bincount(part.flat, minlength=BUCKETS)
            touched = np.flatnonzero(seen)
            step = np.stack([np.bincount(part.flat, each[:, k], BUCKETS)[touched] for k in range(len(DEFECTS))], 1) / len(slope) + l2 * weights[touched]
            squares[touched] += step * step
            weights[touched] -= rate * step / np.sqrt(squares[touched])
    return weights


def fit(sample: list[Example]) -> Classifier:
    """Two fits, the second without exchanges that the first takes for defective, and thresholds from the held-out part."""
    y = np.zeros((len(sample), len(DEFECTS)), np.float32)
    for i, (_, k, _) in enumerate(sample):
        if k >= 0:
            y[i, k] = 1
    rows = Rows([x for x, _, _ in sample])
    held = np.array([h for _, _, h in sample], bool)
    natural = np.array([k < 0 for _, k, _ in sample], bool)
    keep = np.ones(len(sample), bool)
    for _ in range(2):
        learn = np.flatnonzero(keep & ~held)
        weights = _descend(rows.take(learn), y[learn])
        score = rows.margins(weights)
        keep = ~(natural & (score > 0).any(1))
    thresholds = []
    for k in range(len(DEFECTS)):
        good, bad = score[held & keep & natural, k], score[held & (y[:, k] == 1), k]
        low, high = (np.quantile(x, q) if len(x) else 0.0 for x, q in ((good, 1 - ODD_SOUND), (bad, ODD)))
        thresholds.append((low + high) / 2)
    return Classifier(weights, np.array(thresholds, np.float32))


def train(chats: DataFrame, rows: int = TRAIN_ROWS) -> Classifier:
    """Fit on the ``rows`` exchanges with the smallest hash of record_id: a bounded sample that doesn't depend on partitioning. Features
    and synthetic defects are made in ``TRAIN_TASKS`` tasks; the driver gets lists of numbers, a few megabytes, and descends."""
    sample = chats.where(F.col("messages").isNotNull()).select("record_id", "messages").orderBy(F.xxhash64("record_id"), "record_id").limit(rows)
    parts = sample.repartition(TRAIN_TASKS, "record_id").sortWithinPartitions("record_id")

    def batch(ids, all_messages):
        made = examples(list(zip(ids, all_messages)))
        return {"x": [x for x, _, _ in made], "k": [k for _, k, _ in made], "held": [h for _, _, h in made]}

    found = map_columns(parts, ["record_id", "messages"], batch, "x array<int>, k int, held boolean").toArrow()
    return fit(examples(fixed_records()) + list(zip(*(found.column(c).to_pylist() for c in ("x", "k", "held")))))


def defects(chats: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(record_id, defect) of each defective record; map-only once the model (a few megabytes) is sent out."""
    model = chats.sparkSession.sparkContext.broadcast(train(chats, rows))

    def batch(ids, all_messages):
        judged = model.value.defects([features(*exchange(m)) for m in all_messages])
        hit = [i for i, d in enumerate(judged) if d]
        return {"record_id": [ids[i] for i in hit], "defect": [judged[i] for i in hit]}

    return map_columns(chats, ["record_id", "messages"], batch, "record_id bigint, defect string")


def p6_found(chats: DataFrame) -> DataFrame:
    return defects(chats)
