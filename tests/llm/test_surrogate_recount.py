"""Surrogates and scrubbed texts, made again in plain Python for mentions of simple forms."""

import hashlib
import random
import re
from collections import Counter, defaultdict

from docrel.llm import surrogates

KEY = "a key of the test"
FORMS = {
    "person": r"\b(?:Mr|Mrs|Dr)\.? [A-Z][a-z]+ [A-Z][a-z]+", "email": r"[A-Za-z.]+@[a-z]+\.[a-z]{2,3}",
    "ip": r"\b\d{1,3}(?:\.\d{1,3}){3}\b", "card": r"\b\d{4}(?: \d{4}){3}\b", "ssn": r"\b\d{3}-\d\d-\d{4}\b",
    "phone": r"\(\d{3}\) \d{3}-\d{4}"}
MENTION = re.compile("|".join(f"(?P<{k}>{v})" for k, v in FORMS.items()))
GENDER = {"Mr": "m", "Mrs": "f", "Dr": "n"}


def texts():
    r = random.Random(9)
    given = ["Ada", "Bo", "Cy", "Di", "Ed", "Flo", "Gus", "Hal", "Ida", "Jo", "Kai", "Lou", "Max", "Ned", "Ola", "Pia",
             "Quin", "Ray", "Sue", "Tom", "Una", "Val", "Wes", "Xia", "Yul", "Zoe"]
    last = ["Li", "Oz", "Wu", "Ray", "Stone", "Marlowe", "Quill"]  # few letters: surrogates collide

    def mention():
        return r.choice([
            lambda: f"{r.choice(['Mr', 'Mr.', 'Mrs', 'Dr', 'Dr.'])} {r.choice(given)} {r.choice(last)}",
            lambda: f"{r.choice(['a', 'b.c', 'Bo.Li', 'xy'])}@{r.choice(['q', 'io', 'mail'])}.{r.choice(['com', 'de'])}",
            lambda: ".".join(str(r.choice([1, 2, 10, 255])) for _ in range(4)),
            lambda: " ".join(str(r.choice([1234, 5678])) for _ in range(4)),
            lambda: f"{r.choice([123, 456])}-{r.choice([45, 67])}-{r.choice([1111, 2222])}",
            lambda: f"({r.choice([212, 313])}) {r.choice([555, 444])}-{r.choice([1000, 2000])}"])()

    return [" ".join(x for _ in range(r.randrange(5)) for x in (r.choice(["so", "then", "who, asked"]), mention())) + " end."
            for _ in range(120)] + ["", "no mention, but 123 and a@b"]


def number(*parts):
    return int(hashlib.sha256("\x1f".join(map(str, (KEY, *parts))).encode()).hexdigest()[:15], 16)


def spelled(x, draw, kind):
    def char(c, n):
        low = c.lower()
        values = "0123456789" if c.isdigit() else "" if not c.isalpha() else "aeiou" if low in "aeiouy" else "bcdfghklmnprstvz"
        new = values[n % len(values)] if values else c
        return new.upper() if c != low else new

    of = hashlib.sha256(x.encode()).hexdigest()
    return "".join(char(c, number(kind, of, draw, i)) for i, c in enumerate(x))


def candidate(kind, entity, draw):
    assert draw <= surrogates.LONGER_AFTER
    n = number(kind, entity, draw)
    if kind == "email":
        name, _, tail = entity.rpartition(".")
        return spelled(name, draw, kind) + "." + tail
    if kind == "ip":
        ranges = {1: (9, 1), 2: (90, 10), 3: (156, 100)}
        own = [(number(kind, entity, draw, i), *ranges[len(o)]) for i, o in enumerate(entity.split("."))]
        return ".".join(str(x % span + least) for x, span, least in own)
    if kind.startswith("given_"):
        names = surrogates.GIVEN[kind[-1]][0]
        return names[n % len(names)] + (spelled(entity[:min(draw, 4)], draw, kind).lower() if draw else "")
    if kind == "surname":
        return spelled(entity, draw, kind).capitalize()
    head = 1 if kind == "card" else 0
    return entity[:head] + spelled(entity[head:], draw, kind)


def parts(m):
    """(kind, entity) of a mention's entities."""
    kind, whole = m.lastgroup, m.group()
    if kind == "person":
        title, given, last = whole.split(" ")
        return [("given_" + GENDER[title.rstrip(".")], given), ("surname", last)]
    return [(kind, whole.lower() if kind == "email" else whole if kind == "ip" else re.sub(r"\D", "", whole))]


def scrubbed(rows):
    documents = [list(dict.fromkeys(e for m in MENTION.finditer(t) for e in parts(m))) for t in rows]
    seen = Counter(e for found in documents for e in found)

    def settled(kind, entity):
        f, m = seen["given_f", entity], seen["given_m", entity]
        return kind if kind != "given_n" or not f + m else "given_f" if f >= m else "given_m"

    as_kind = {e: settled(*e) for e in seen}
    todo = {(as_kind[e], e[1]) for e in seen}
    group = lambda kind: kind.split("_")[0]
    real = {(group(k), x) for k, x in todo}
    done, taken, draw, collided = {}, set(), 0, 0
    while todo:
        drawn = defaultdict(list)
        for k, x in todo:
            drawn[group(k), candidate(k, x, draw)].append((number(k, x), k, x))
        for at, own in drawn.items():
            collided += len(own) > 1 or at in taken or at in real
            if at not in taken and at not in real:
                _, k, x = min(own)
                done[k, x] = at[1]
        taken, todo, draw = {(group(k), s) for (k, _), s in done.items()}, todo - done.keys(), draw + 1
    of = lambda e: done[as_kind[e], e[1]]

    def replaced(m):
        new = [of(e) for e in parts(m)]
        if m.lastgroup == "person":
            return " ".join([m.group().split(" ")[0], *new])
        if m.lastgroup in ("email", "ip"):
            return new[0]
        digits = iter(new[0])
        return re.sub(r"\d", lambda _: next(digits), m.group())

    out = [(i, len(MENTION.findall(t)), len({(as_kind[e], of(e)) for e in found}), MENTION.sub(replaced, t))
           for i, (t, found) in enumerate(zip(rows, documents))]
    return out, collided, as_kind


def test_scrubbed_texts_row_by_row(spark):
    rows = texts()
    want, collided, as_kind = scrubbed(rows)
    assert collided and any(k == "given_n" and as_kind[k, x] != k for k, x in as_kind)
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = surrogates.scrubbed(docs, KEY).select("doc_id", "n_mentions", "n_entities", "text").collect()
    assert sorted(map(tuple, got)) == want
