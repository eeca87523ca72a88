"""Main text of web pages with a linear-chain conditional random field over leaf blocks.

A page becomes the sequence of its leaf blocks (`page_blocks`). Features of a block are its
ancestors' tags, the words of their class, id and role attributes and the families of such
words, the nearest telling ancestors, and coarse measures of its text. The field has two
labels, main text or not; it is trained by maximum likelihood (forward-backward gradients,
AdaGrad) on `labelled_pages`: `TRAINING_PAGES` pages with many layouts, drawn by rule with a
seed, in which every element's label is known. Viterbi picks the best labels of a page.

Extraction is row-local: no shuffle. The model is trained once while the plan is made and
travels with the tasks; its size is that of the training pages' features.
"""

import random
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quarry.llm.page_blocks import leaf_blocks

TRAINING_PAGES, SEED, EPOCHS, RATE, DECAY = 400, 11, 12, 0.3, 1e-4

# Words of class, id and role attributes by what they usually name.
FAMILIES = {
    "ad": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner dfp",
    "notice": "cookie cookies consent gdpr notice alert warning popup modal overlay toast paywall disclaimer announcement message",
    "side": "sidebar side aside rail widget widgets related recommended recommendations trending popular latest teaser complementary more",
    "comment": "comment comments commentlist discussion reply replies respond disqus feedback reviews review thread",
    "nav": "nav navigation navbar navi menu menus breadcrumb breadcrumbs pagination pager toc links skip topbar tabs navigator",
    "share": "share sharing social follow like tweet buttons toolbar tools",
    "form": "form login signin signup register subscribe subscription newsletter search input contact poll",
    "foot": "footer foot bottom copyright legal imprint colophon contentinfo credits",
    "head": "header head masthead top logo brand branding site banner hero",
    "meta": "meta byline author date time tags tag categories category info caption",
    "main": "article articles content main post entry story body text prose page copy blog document",
    "hidden": "hidden invisible hide",
}
FAMILY = {word: family for family, words in FAMILIES.items() for word in words.split()}
TELLING = frozenset("article main nav header footer aside form section figure table button select fieldset dialog menu search".split())


def bucket(n, edges):
    return sum(n >= e for e in edges)


class Around:
    """What counts of an element and those around it; each is made from that of the parent."""

    __slots__ = ("fresh", "families", "near", "second", "main", "value")

    def __init__(self, parent, element, weights):
        self.families, self.near, self.second, self.main = parent.families, parent.near, parent.second, parent.main
        self.fresh = [f"tag:{element.tag}"] if element.fresh_tag else []
        self.fresh += [f"word:{w}" for w in element.fresh_words]
        markers = [element.tag] if element.tag in TELLING else []
        for family in dict.fromkeys(FAMILY[w] for w in element.words if w in FAMILY):
            markers.append("." + family)
            if family not in self.families:
                self.families = self.families | {family}
                self.fresh.append(f"family:{family}")
        for marker in markers:
            self.near, self.second = marker, self.near
            self.main = self.main or marker in ("article", "main", ".main")
        self.value = parent.value + sum(weights.get(f, 0.0) for f in self.fresh)


class Outside(Around):
    """What is around a text that stands in no element."""

    def __init__(self):
        self.fresh, self.families, self.near, self.second, self.main, self.value = [], frozenset(), "none", "none", False, 0.0


def around(element, known, weights):
    """The `Around` of an element, kept in `known` together with those of its ancestors."""
    chain = []
    while element not in known:
        chain.append(element)
        element = element.parent
    for node in reversed(chain):
        known[node] = Around(known[node.parent], node, weights)
    return known[chain[0] if chain else element]


def place_features(element, state):
    """Features of a block's place that are not added up along the way."""
    tag, depth = (element.tag, element.depth) if element else ("none", 0)
    return [
        f"near:{state.near}", f"near2:{state.second}>{state.near}", f"parent:{tag}", f"inside:{state.main}",
        f"inside:{state.main}>{state.near}", f"depth:{bucket(depth, (3, 5, 7, 10))}",
    ]


def text_features(block):
    text = block.text
    size = bucket(text.count(" ") + 1, (2, 4, 8, 16, 32, 64))
    link = bucket(block.linked, (0.01, 0.3, 0.7))
    end = "stop" if text[-1] in ".!?…:;\"”»" else "open"
    out = [f"size:{size}", f"link:{link}", f"end:{end}", f"size:{size}>{end}"]
    if text[0] in "©®™|»›" or "©" in text:
        out.append("sign")
    return out


def features(blocks):
    """All features of every block, those of its ancestors among them."""
    known = {None: Outside()}
    for block in blocks:
        out = [*place_features(block.element, around(block.element, known, {})), *text_features(block)]
        element = block.element
        while element:
            out += known[element].fresh
            element = element.parent
        yield out


class Writer:
    """Draws pages with known labels; every choice comes from one seeded generator."""

    def __init__(self, seed):
        self.random = random.Random(seed)
        letters = "etaoinshrdlucmfwypvbgkéèüßñó"
        self.lexicon = ["".join(self.random.choices(letters, k=self.random.randint(1, 9))) for _ in range(600)]

    def words(self, low, high):
        return " ".join(self.random.choices(self.lexicon, k=self.random.randint(low, high)))

    def sentence(self):
        return self.words(2, 18).capitalize() + self.random.choice((".", ".", ".", "!", "?"))

    def prose(self, low, high):
        return " ".join(self.sentence() for _ in range(self.random.randint(low, high)))

    def link(self):
        return f'<a href="/{self.random.choice(self.lexicon)}">{self.words(1, 4)}</a>'

    def named(self, family):
        """An attribute with a word of the family, alone or with others."""
        word = self.random.choice(FAMILIES[family].split())
        extra = self.random.choice(("", "", "-box", " clear", "-inner", " wrap", "_1"))
        return f'{self.random.choice(("class", "class", "id"))}="{word}{extra}"'

    def links(self, low=3, high=9):
        items = [self.link() for _ in range(self.random.randint(low, high))]
        style = self.random.randrange(3)
        if style == 0:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return (" | " if style == 1 else " ").join(items)

    def paragraph(self):
        pick = self.random.random()
        if pick < 0.15:
            return f"<p>{self.sentence()}"
        if pick < 0.25:
            return f"<p><b>{self.prose(1, 3)}<br>"
        if pick < 0.4:
            return f"<p>{self.words(1, 4)}.</p>"
        if pick < 0.5:
            return f"<p>{self.prose(1, 3)} {self.link()} {self.prose(1, 2)}</p>"
        if pick < 0.6:
            return f"<p>{self.words(5, 60)}</p>"
        return f"<p>{self.prose(1, 8)}</p>"

    def main_part(self):
        pick = self.random.random()
        if pick < 0.6:
            return self.paragraph()
        if pick < 0.7:
            return f"<h{self.random.randint(2, 4)}>{self.words(1, 7)}</h2>"
        if pick < 0.78:
            tag = self.random.choice(("ul", "ol"))
            return f"<{tag}>" + "".join(f"<li>{self.words(1, 12)}</li>" for _ in range(self.random.randint(2, 5))) + f"</{tag}>"
        if pick < 0.84:
            return f"<blockquote>{self.prose(1, 3)}</blockquote>"
        if pick < 0.88:
            return f"<pre>{self.words(3, 12)}</pre>"
        if pick < 0.92:
            return "<table>" + "".join(f"<tr><td>{self.words(1, 3)}</td><td>{self.words(1, 3)}</td></tr>" for _ in range(3)) + "</table>"
        if pick < 0.96:
            return f"<div>{self.prose(1, 4)}</div>"
        return f"<section><h2>{self.words(1, 5)}</h2>{self.paragraph()}{self.paragraph()}</section>"

    def fill(self):
        """What a box beside the main text may hold."""
        pick = self.random.random()
        if pick < 0.35:
            return self.links()
        if pick < 0.65:
            return self.prose(1, 3)
        if pick < 0.72:
            return self.words(3, 40)
        if pick < 0.87:
            return f"<p>{self.prose(1, 4)}</p>" * self.random.randint(1, 2)
        return f"<h3>{self.words(1, 4)}</h3>{self.links(2, 5)}"

    def box(self, family, tags=("div", "div", "section")):
        tag = self.random.choice(tags)
        return f'<{tag} {self.named(family)} data-main="0">{self.fill()}</{tag}>'

    def comments(self):
        rows = []
        for _ in range(self.random.randint(1, 5)):
            tag = self.random.choice(("div", "li", "article"))
            rows.append(f'<{tag} class="comment"><p>{self.words(1, 2)}</p><p>{self.prose(1, 3)}</p></{tag}>')
        tag = self.random.choice(("section", "div", "ol"))
        return f'<{tag} {self.named("comment")} data-main="0"><h3>{self.words(1, 3)}</h3>{"".join(rows)}</{tag}>'

    def form(self):
        return (
            f'<form data-main="0"><label>{self.words(1, 3)}</label><input name="q"><p>{self.prose(0, 2)}</p>'
            f"<select><option>{self.words(1, 2)}<option>{self.words(1, 2)}</select><button>{self.words(1, 2)}</button></form>"
        )

    def noise(self):
        pick = self.random.random()
        if pick < 0.12:
            return self.form()
        if pick < 0.27:
            return f'<aside data-main="0">{self.fill()}</aside>'
        if pick < 0.34:
            return f'<nav data-main="0">{self.links(2, 5)}</nav>'
        return self.box(self.random.choice(("ad", "ad", "notice", "notice", "side", "side", "share", "nav", "form", "hidden")))

    def article(self):
        parts = [self.main_part() for _ in range(self.random.choice((1, 2, 4, 8, 14)))]
        if self.random.random() < 0.8:
            title = f"<h1>{self.words(1, 12)}</h1>"
            parts.insert(0, f"<header>{title}</header>" if self.random.random() < 0.15 else title)
        for _ in range(self.random.choice((0, 0, 1, 2))):
            parts.insert(self.random.randint(1, len(parts)), self.noise())
        if self.random.random() < 0.15:
            parts.append(self.comments())
        if self.random.random() < 0.1:
            parts.append(f'<footer data-main="0">{self.fill()}</footer>')
        tag, name = self.random.choice((
            ("article", ""), ("article", ""), ("article", ""), ("main", ""), ("div", self.named("main")), ("section", self.named("main")), ("div", ""), ("td", "")
        ))
        body = "".join(parts)
        if tag == "td":
            return f'<table><tr><td data-main="0">{self.links()}</td><td data-main="1">{body}</td></tr></table>'
        inner = f'<{tag} {name} data-main="1">{body}</{tag}>'
        return f"<main>{inner}</main>" if self.random.random() < 0.25 else inner

    def page(self):
        before, after = [], []
        if self.random.random() < 0.7:
            before.append(f'<header data-main="0">{self.fill()}</header>')
        elif self.random.random() < 0.5:
            before.append(self.box("head"))
        if self.random.random() < 0.8:
            before.append(f'<nav data-main="0">{self.links()}</nav>')
        else:
            before.append(self.box("nav"))
        (before if self.random.random() < 0.5 else after).extend(self.noise() for _ in range(self.random.randint(0, 3)))
        if self.random.random() < 0.35:
            after.append(self.comments())
        if self.random.random() < 0.8:
            after.append(f'<footer data-main="0">&copy; {self.words(1, 3)} &middot; {self.fill()}</footer>')
        else:
            after.append(self.box("foot"))
        wrap = self.random.choice((("", ""), ("<div>", "</div>"), ('<div class="wrap">', "</div>"), ('<div id="page">', "</div>")))
        return (
            f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title><style>p{{}}</style></head><body>{wrap[0]}"
            + "".join(before) + self.article() + "".join(after) + wrap[1] + self.random.choice(("</body></html>", ""))
        )


def labelled_pages(count, seed=SEED):
    """(blocks, labels) of generated pages."""
    writer = Writer(seed)
    for _ in range(count):
        blocks = leaf_blocks(writer.page(), written_label)
        yield blocks, [b.element.label if b.element else 0 for b in blocks]


def written_label(attributes, surrounding):
    """The label that the writer gave an element; without one, that of the element around it."""
    found = re.search(r'data-main="([01])"', attributes)
    return int(found[1]) if found else surrounding


class Field:
    """Weights of label 1 against label 0 per feature, and of the steps between labels."""

    def __init__(self, weights, steps, first):
        self.weights, self.steps, self.first = weights, steps, first

    def decode(self, blocks):
        """Viterbi: the best labels."""
        if not blocks:
            return []
        get = self.weights.get
        scores, known = [], {None: Outside()}
        for block in blocks:
            state = around(block.element, known, self.weights)
            own = [*place_features(block.element, state), *text_features(block)]
            scores.append(state.value + sum(get(f, 0.0) for f in own))
        (stay0, to1), (to0, stay1) = self.steps
        a, b, back = 0.0, self.first + scores[0], []
        for score in scores[1:]:
            from0, from1 = a + stay0 >= b + to0, a + to1 >= b + stay1
            back.append((0 if from0 else 1, 0 if from1 else 1))
            a, b = max(a + stay0, b + to0), max(a + to1, b + stay1) + score
        labels = [0 if a >= b else 1]
        for choice in reversed(back):
            labels.append(choice[labels[-1]])
        return labels[::-1]


def marginals(scores, steps, first):
    """P(label 1) of every block, and the expected counts of the four steps, by forward-backward."""
    count = len(scores)
    emit = np.zeros((count, 2))
    emit[:, 1] = scores
    emit[0, 1] += first
    forward, backward = np.zeros((count, 2)), np.zeros((count, 2))
    forward[0] = emit[0]
    for t in range(1, count):
        forward[t] = np.logaddexp(forward[t - 1, 0] + steps[0], forward[t - 1, 1] + steps[1]) + emit[t]
    for t in range(count - 2, -1, -1):
        ahead = emit[t + 1] + backward[t + 1]
        backward[t] = np.logaddexp(steps[:, 0] + ahead[0], steps[:, 1] + ahead[1])
    total = np.logaddexp(*forward[-1])
    pairs = np.exp(forward[:-1, :, None] + steps[None] + (emit[1:] + backward[1:])[:, None, :] - total)
    return np.exp(forward + backward - total)[:, 1], pairs.sum(axis=0)


@lru_cache(maxsize=4)
def train(count=TRAINING_PAGES, seed=SEED, epochs=EPOCHS):
    """A `Field` fitted to `count` generated pages."""
    index, pages = {}, []
    for blocks, labels in labelled_pages(count, seed):
        if blocks:
            rows = [[index.setdefault(f, len(index)) for f in sorted(fs)] for fs in features(blocks)]
            owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
            pages.append((np.concatenate(rows), owner, np.array(labels, float)))
    size = len(index)
    weights, seen = np.zeros(size + 5), np.full(size + 5, 1e-6)
    order = random.Random(seed)
    for _ in range(epochs):
        order.shuffle(pages)
        for columns, owner, labels in pages:
            scores = np.bincount(owner, weights[columns], len(labels))
            steps, first = weights[size : size + 4].reshape(2, 2), weights[size + 4]
            chance, pairs = marginals(scores, steps, first)
            gradient = np.bincount(columns, (labels - chance)[owner], size + 5)
            kinds = (2 * labels[:-1] + labels[1:]).astype(int)
            gradient[size : size + 4] = np.bincount(kinds, minlength=4) - pairs.ravel()
            gradient[size + 4] = labels[0] - chance[0]
            gradient -= DECAY * weights
            seen += gradient * gradient
            weights += RATE * gradient / np.sqrt(seen)
    return Field({f: float(weights[k]) for f, k in index.items()}, weights[size : size + 4].reshape(2, 2).tolist(), float(weights[size + 4]))


def main_text(page, field):
    """The blocks of the main text, one per line; '' if there are none."""
    if not page:
        return ""
    blocks = leaf_blocks(page)
    return "\n".join(b.text for b, label in zip(blocks, field.decode(blocks)) if label)


def extract(pages, page_id="page_id", url="url", html="html", field=None):
    """(page_id, url, text, n_chars) of every row. Null and empty pages have the empty text.

    Broken markup is read as far as it goes: unclosed elements end with their container, and an
    unclosed comment or script ends with the page. Repeated rows each get their row; other
    columns are ignored.
    """
    field = field or train()
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    ids = rows.schema["page_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = [main_text(page, field) for page in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return rows.mapInArrow(run, f"page_id {ids}, url string, text string, n_chars long")
