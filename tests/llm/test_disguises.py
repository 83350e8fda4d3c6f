"""Disguised identifiers planted in ordinary text: recall by family, exact spans, and clean text left alone."""

import random

import pytest

from shopmart.llm import disguises, lookalikes, pii, spoken

NAMES = "jane maria li.wei tom_k r.silva ahmed99 olga-p sofia.m bob nadia".split()
HOSTS = "example studio my-shop mail7 northwind kino bluebird uni-bonn acme q4labs".split()
TOPS = "com org net io de fr es it co tech".split()
AROUND = [("write to ", " today"), ("you can reach me: ", "."), ("contact ", ", thanks"), ("", "")]
UNITS = "zero one two three four five six seven eight nine".split()
TEENS = ("ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen").split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()


def styled(first):
    """Letters of one mathematical alphabet."""
    return lambda s: "".join(chr(ord(first) + ord(c) - 97) if "a" <= c <= "z" else c for c in s)


def spell(n):
    """A number below 256 in words."""
    if n >= 100:
        rest = f" and {spell(n % 100)}" if n % 100 else ""
        return f"{UNITS[n // 100]} hundred{rest}"
    if n >= 20:
        return TENS[n // 10 - 2] + (f" {UNITS[n % 10]}" if n % 10 else "")
    return TEENS[n - 10] if n >= 10 else UNITS[n]


def spread(s):
    return " ".join(s)


MAILS = {
    "bold": lambda n, h, t: styled("𝐚")(f"{n}@{h}.{t}"),
    "script": lambda n, h, t: styled("𝓪")(f"{n}@{h}.{t}"),
    "monospace": lambda n, h, t: styled("𝚊")(f"{n}@{h}.{t}"),
    "circled": lambda n, h, t: styled("ⓐ")(f"{n}@{h}.{t}"),
    "full width": lambda n, h, t: "".join(chr(ord(c) + 0xFEE0) for c in f"{n}@{h}.{t}"),
    "cyrillic": lambda n, h, t: f"{n}@{h}.{t}".translate(str.maketrans("aeopc", "аеорс")),
    "brackets": lambda n, h, t: f"{n} [at] {h} [dot] {t}",
    "letter a": lambda n, h, t: f"{n}(a){h}.{t}",
    "stars": lambda n, h, t: f"{n} *at* {h} *dot* {t}",
    "bars": lambda n, h, t: f"{n}|at|{h}|dot|{t}",
    "underscores": lambda n, h, t: f"{n}_at_{h.replace('-', '')}_dot_{t}",
    "hyphens": lambda n, h, t: f"{n}-at-{h.replace('-', '')}-dot-{t}",
    "capitals": lambda n, h, t: f"{n}AT{h}DOT{t}",
    "decimal reference": lambda n, h, t: f"{n}&#64;{h}&#46;{t}",
    "hexadecimal reference": lambda n, h, t: f"{n}&#x40;{h}.{t}",
    "named reference": lambda n, h, t: f"{n}&commat;{h}&period;{t}",
    "percent": lambda n, h, t: f"{n}%40{h}.{t}",
    "spread": lambda n, h, t: spread(f"{n}@{h}.{t}"),
    "spread words": lambda n, h, t: "  ".join(map(spread, (n, "at", h, "dot", t))),
    "words": lambda n, h, t: f"{n} at {h} dot {t}",
    "Spanish": lambda n, h, t: f"{n} arroba {h} punto {t}",
    "German": lambda n, h, t: f"{n} bei {h} punkt {t}",
    "French": lambda n, h, t: f"{n} chez {h} point {t}",
}


@pytest.mark.parametrize("family", MAILS)
def test_recall_of_planted_addresses(family):
    rng = random.Random(family)
    found = total = 0
    for i in range(200):
        before, after = AROUND[i % len(AROUND)]
        piece = MAILS[family](rng.choice(NAMES), rng.choice(HOSTS), rng.choice(TOPS))
        base, spans = pii.find(before + piece + after)
        assert set(base) <= set(spans)
        found += ("email", len(before), len(before) + len(piece)) in spans
        total += 1
    assert found >= 0.9 * total, (family, found / total)


def numbers(rng):
    """Kind, disguised form."""
    octets = [rng.randint(0, 255) for _ in range(4)]
    yield "ip", " dot ".join(map(spell, octets))
    yield "ip", " dot ".join(" ".join(UNITS[int(c)] for c in str(o)) for o in octets)
    yield "ip", " dot ".join(map(str, octets))
    digits = [rng.randint(0, 9) for _ in range(10)]
    yield "phone", "plus " + " ".join(UNITS[d] for d in [4, 4, *digits])
    yield "phone", "plus forty four " + ", ".join(UNITS[d] for d in digits)
    yield "phone", f"plus four nine double {UNITS[digits[0]]} triple {UNITS[digits[1]]} " + " ".join(
        UNITS[d] for d in digits[2:6])
    card = [4] + [rng.randint(0, 9) for _ in range(14)]
    card.append(-sum((2 * d) // 10 + (2 * d) % 10 if i % 2 == 0 else d for i, d in enumerate(card)) % 10)
    yield "card", " ".join(UNITS[d] for d in card)
    yield "card", styled_digits("𝟎", card)
    yield "card", styled_digits("𝟶", card)


def styled_digits(zero, digits):
    return "".join(chr(ord(zero) + d) for d in digits)


def test_recall_of_planted_numbers():
    rng = random.Random(4)
    seen = {}
    for i in range(100):
        before, after = AROUND[i % len(AROUND)]
        for j, (kind, piece) in enumerate(numbers(rng)):
            hit = (kind, len(before), len(before) + len(piece)) in pii.find(before + piece + after)[1]
            seen.setdefault((j, kind), []).append(hit)
    assert all(sum(hits) >= 0.9 * len(hits) for hits in seen.values()), {
        k: sum(v) / len(v) for k, v in seen.items()}


def test_clean_documents_get_no_added_span(texts):
    """Documents without disguise, and ordinary sentences with the same words and marks."""
    for text in texts.values():
        base, spans = pii.find(text or "")
        assert base == spans


@pytest.mark.parametrize("text", [
    "def created_at_time(self): return look_at_me.dot_product", "state-at-rest and dot-at-end",
    "a b c d e f g h i j", "FORMATted.com and THATched", "wir essen bei anna und trinken dann",
    "acheter chez amazon point final", "commande chez amazon.fr", "he bought twenty one of forty four",
    "double trouble, one hundred and one dalmatians", "x = y|at|z", "option (a) or (b) of 4(a)",
    "A & B; R&D &amp; more", "100%4000", "1² + 2² = 5, ½ ﬁne Ⅳ", "① first ② second ③ third",
    "three point one four one five nine", "one dot two dot three", "plus one more, plus two"])
def test_ordinary_text_is_left_alone(text):
    assert pii.find(text) == ([], [])


def test_numbers_in_words():
    def said(text):
        return [new for _, _, new in spoken.numbers(text, 0, len(text))]

    assert said("one hundred and ninety two") == ["192"] and said("two hundred") == ["200"]
    assert said("forty four oh seven") == ["44", "0", "7"] and said("ten, twenty, twenty one") == ["10", "20", "21"]
    assert said("double five triple 0 double") == ["55", "000"] and said("hundred double trouble") == []
    assert said("zero hundred") == ["0"] and said("") == []


def test_every_character_keeps_its_source():
    for text in ("j a n e  a t  x y  d o t  c o m", "jane&#64;ex&#46;com", "forty four dot ten", "a *at* b *dot* c"):
        new = pii.rewrite(text)
        assert len(new.text) == len(new.start) == len(new.stop)
        assert all(0 <= a < b <= len(text) for a, b in zip(new.start, new.stop))
        assert new.start == sorted(new.start) and new.stop == sorted(new.stop)


def test_hard_texts_are_linear():
    for piece in ("a_at_", "a-at-b-dot-", "aATb.", "a ", "@ ", "(a)", "&#64;", "*at*", "* ", "hundred ", "one dot ",
                  "double ", "plus ", "a t "):
        pii.find(piece * 40_000)
    assert not disguises.signs("", "")


def test_styled_letters():
    folded = "".join(map(lookalikes.fold_char, "𝐣𝐚ⓐ🅰🅐①＠﹫．４𝟙ﬁⅣ"))
    assert folded == "jaaAA1@@.41ﬁⅣ"
