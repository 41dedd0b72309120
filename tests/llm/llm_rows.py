"""Rows that the tests of the training-data operators share."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, kept string, component_id string, id string,"
    " place string, rest string, bands string, judged_pred string, `a b.c` string"
)
WORDS = {
    "en": "the of and to in is that for with was by on are this from not have were which their".split(),
    "de": "der die und zu den das nicht von sie ist des sich mit dem dass er es ein ich auf".split(),
    "fr": "le de la et les des en un du une que est pour qui dans par plus pas au sur".split(),
}


def prose(rng: random.Random, lang: str, words: int) -> str:
    """Sentences of invented words over a language's common words, in lines."""
    own = WORDS[lang]
    out = []
    for _ in range(words):
        out.append(rng.choice(own) if rng.random() < 0.5 else "".join(rng.choice(own) for _ in range(2)))
        if rng.random() < 0.1:
            out[-1] += rng.choice([".", ",", ".\n", " é.", "!"])
    return " ".join(out)


def messy_rows() -> list[tuple]:
    """Documents with nulls, empty and long texts, exact and near copies, repeated rows and shared passages."""
    rng = random.Random(11)
    texts: list[tuple[int | None, str | None, str | None]] = []
    for i in range(60):
        lang = list(WORDS)[i % 3]
        texts.append((i, prose(rng, lang, rng.randint(1, 200)), lang))
    passage = prose(rng, "en", 120)
    for i in range(60, 70):
        texts.append((i, prose(rng, "en", 30) + " " + passage + " " + prose(rng, "en", rng.randint(1, 60)), "en"))
    long = prose(rng, "de", 20_000)
    texts += [(70, long, "de"), (71, long, None), (72, None, "en"), (73, "", "en"), (74, "…!? 12", None), (75, "a", "fr")]
    words = texts[5][1].split(" ") if len(texts[5][1].split(" ")) > 60 else prose(rng, "fr", 100).split(" ")
    texts += [(76, " ".join(words), "fr"), (77, " ".join([*words[:-1], "changed"]), "fr"), (78, " ".join(["other", *words]), "fr")]
    texts += [(80, "aaaa" * 400, "en"), (81, "日本語のテキスト" * 60, None), (82, "x  y\t\tz \n\n w ", "en"), (83, "▁ ▁▁ <|endoftext|> end", "en")]
    texts += [(None, texts[0][1], "en"), (None, None, None), texts[3], texts[3], (10**12, texts[1][1], "de"), (-5, texts[2][1], "fr")]
    return [
        (i, t, lang, None if i is None else f"src{i % 3}", None if t is None else len(t), "k", "c", "i", "p", "r", "b", "j", "x")
        for i, t, lang in texts
    ]
