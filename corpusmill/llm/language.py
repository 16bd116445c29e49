"""Language of short technical prose among en, ko, de, es, fr, ja, zh: script first, then function words."""

from __future__ import annotations

import re

# Frequent function words of the Latin-script languages.
FUNCTION_WORDS = {
    "en": "the a an is are was were be been to of and or in on at by for with from that this it its as if than then so not no do does did has have had will would can could should must may might when while which who what how why we you they he she i my your our their there here only every each both all any some same into over under after before because since until yet but out up down off once more less most please make sure one two nobody nothing anymore per copyright contributors licensed",
    "de": "der die das den dem des ein eine einen einem einer und oder nicht kein keine ist sind war wird werden wurde hat haben darf dürfen muss müssen kann können soll sollte man nur wenn falls dass damit bis zum zur mit von vom für auf aus bei nach vor über unter ohne diese dieser dieses diesen hier danach noch einmal mehr als genug bitte achtung leider seit wir sie es ich sich erst wirklich etwa stattdessen vorher niemand automatisch gibt wie warum",
    "es": "el la los las un una unos unas y o no ni es son era está están ha han hay que de del al en con por para sin sobre entre si se su sus lo le les cuando como más menos muy ya esta este estos aquí antes después cada vez primero siempre desde hasta hacia donde porque debe deben puede pueden todo todos toda otra otro usa unos cómo qué olvides",
    "fr": "le la les un une des du de et ou ne pas plus est sont était être a ont il elle on nous vous que qui quand si ce cette ces dans sur sous avec sans pour par au aux en se son sa ses afin puis avant après toujours même bien déjà depuis dernière tout toute tous pouvoir faut peut doit attention ici environ malheureusement d'abord comme où l d n qu c s j",
}
_VOTES: dict[str, dict[str, float]] = {}
for _lang, _words in FUNCTION_WORDS.items():
    for _w in _words.split():
        _VOTES.setdefault(_w, {})[_lang] = 1.0
for _w, _v in _VOTES.items():
    for _lang in _v:
        _v[_lang] = 1.0 / len(_v)
_LETTERS = {"de": "äöüß", "es": "ñ¿¡áíóú", "fr": "àâçéèêëîïôùûœ"}
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*")
HAN = re.compile(r"[㐀-鿿豈-﫿]")
KANA = re.compile(r"[ぁ-ヿｦ-ﾟ]")
LATIN = re.compile(r"[A-Za-z]")
HANGUL = re.compile(r"[가-힣ᄀ-ᇿ]")


def latin_scores(text: str, found: list[str] | None = None) -> tuple[dict[str, float], int]:
    """Votes of function words and typical letters, and the number of words; ``found`` are the words in lower case where they are known."""
    score = dict.fromkeys(FUNCTION_WORDS, 0.0)
    low = text.lower()
    if found is None:
        found = WORD.findall(low)
    for w in found:
        if w in _VOTES:
            for lang, v in _VOTES[w].items():
                score[lang] += v
        elif "'" in w:
            for part in w.split("'"):
                for lang, v in _VOTES.get(part, {}).items():
                    score[lang] += v
    if not text.isascii():
        for lang, letters in _LETTERS.items():
            score[lang] += min(1.5, 0.5 * sum(map(low.count, letters)))
    return score, len(found)


def language(text: str, least: float = 1.5, found: list[str] | None = None) -> str | None:
    """The language that a text is written in, or None where too little speaks for any."""
    if not text.isascii() and max(text) >= "\u1100":
        hangul, kana, han = len(HANGUL.findall(text)), len(KANA.findall(text)), len(HAN.findall(text))
        cjk = hangul + kana + han
        if cjk >= 12 or cjk >= 4 and cjk * 3 >= len(LATIN.findall(text)):
            if hangul >= kana + han:
                return "ko"
            return "ja" if kana >= max(2, 0.12 * (kana + han)) else "zh"
    score, words = latin_scores(text, found)
    if not words:
        return None
    best = max(score, key=lambda k: score[k])
    return best if score[best] >= least else None
