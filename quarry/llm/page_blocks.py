"""Leaf blocks of a web page: texts between block-level tags, with their ancestors."""

import html
import re

NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)")
# Attributes up to the tag's end, which does not stand inside quotes.
QUOTED = re.compile(r"""(?:"[^"]*+"|'[^']*+'|[^>"'])*+>""")
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""")
TOKEN = re.compile(r"[a-z]+|[A-Z][a-z]*")

# Elements by their role in the HTML standard.
RAW = frozenset("script style title textarea template iframe svg".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol option p pre search section select summary table tbody td "
    "tfoot th thead tr ul xmp".split()
)
# A start tag of the key closes an open element of the set, up to the nearest container.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
CONTAINERS = frozenset("ul ol menu dl table tbody thead tfoot select div section article main aside nav body form".split())


class Element:
    """An open block-level element, linked to the one around it.

    `words` are those of class, id and role. `fresh_tag` and `fresh_words` are what no element
    around it has. `barrier` and `row_barrier` are the places of the nearest containers that
    end the search for an element to close. `label` is what the reader's caller made of it.
    """

    __slots__ = ("parent", "tag", "words", "fresh_tag", "fresh_words", "depth", "barrier", "row_barrier", "label")

    def __init__(self, parent, tag, attributes, label):
        self.parent, self.tag, self.words, self.label = parent, tag, element_words(attributes), label
        self.depth = parent.depth + 1 if parent else 1
        place = self.depth - 1
        self.barrier = place if tag in CONTAINERS else (parent.barrier if parent else -1)
        inside_row = tag in CONTAINERS and tag not in ("tbody", "thead", "tfoot")
        self.row_barrier = place if inside_row else (parent.row_barrier if parent else -1)


def element_words(attributes):
    if not attributes:
        return ()
    found = {m[0].lower(): m[1] or m[2] or m[3] for m in ATTRIBUTE.findall(attributes)}
    named = " ".join(found[k] for k in ("class", "id", "role") if k in found)
    words = tuple(dict.fromkeys(w.lower() for w in TOKEN.findall(named)))
    low = attributes.lower()
    if "display:none" in low.replace(" ", "") or re.search(r"\bhidden\b(?!=)", low) or 'aria-hidden="true"' in low:
        words += ("hidden",)
    return words


class Block:
    """A text, the element it stands in (None outside of all), and the share of its characters inside links."""

    __slots__ = ("text", "element", "linked")

    def __init__(self, text, element, linked):
        self.text, self.element, self.linked = text, element, linked


class Stack:
    """The open elements; all steps take constant time, whatever the depth."""

    def __init__(self):
        self.open, self.places, self.tags, self.words = [], {}, {}, {}

    @property
    def top(self):
        return self.open[-1] if self.open else None

    def push(self, tag, attributes, label):
        element = Element(self.top, tag, attributes, label)
        element.fresh_tag = not self.tags.get(tag)
        element.fresh_words = tuple(w for w in element.words if not self.words.get(w))
        self.places.setdefault(tag, []).append(len(self.open))
        self.tags[tag] = self.tags.get(tag, 0) + 1
        for word in element.words:
            self.words[word] = self.words.get(word, 0) + 1
        self.open.append(element)

    def cut(self, place):
        """Close the element at that place and all inside of it."""
        while len(self.open) > place:
            element = self.open.pop()
            self.places[element.tag].pop()
            self.tags[element.tag] -= 1
            for word in element.words:
                self.words[word] -= 1

    def close(self, tag):
        if self.places.get(tag):
            self.cut(self.places[tag][-1])

    def close_before(self, tag):
        """What a start tag closes: an open paragraph, and the nearest element of `CLOSES` inside the nearest container."""
        if self.open and self.top.tag == "p":
            self.cut(len(self.open) - 1)
        if self.open and tag in CLOSES:
            found = max((self.places[t][-1] for t in CLOSES[tag] if self.places.get(t)), default=-1)
            barrier = self.top.row_barrier if tag == "tr" else self.top.barrier
            if found > barrier:
                self.cut(found)


class Tags:
    """The tags of a page from a place on: each step passes over its text once.

    A tag ends at the first `>` outside of quotes. Where quotes never close, that tag and all
    later ones end at their first `>`.
    """

    def __init__(self, page):
        self.page, self.quotes, self.last = page, True, page.rfind(">")

    def next(self, at):
        """(start, end, closing, name, attributes) of the next tag; the name is None for comments and declarations."""
        page = self.page
        while True:
            start = page.find("<", at)
            if start < 0:
                return None
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, len(page) if end < 0 else end + 3, False, None, ""
            if start > self.last:
                return None
            if page[start + 1 : start + 2] in ("!", "?"):
                return start, page.find(">", start) + 1, False, None, ""
            name = NAME.match(page, start + 1)
            if name:
                end = self.end(name.end())
                return start, end, bool(name[1]), name[2].lower(), page[name.end() : end - 1]
            at = start + 1

    def end(self, at):
        if self.quotes:
            found = QUOTED.match(self.page, at)
            if found:
                return found.end()
            self.quotes = False
        return self.page.find(">", at) + 1


def leaf_blocks(page, label_of=None):
    """The blocks of a page in order.

    `label_of`, of (attributes, the surrounding label), gives elements of training pages their label.
    """
    blocks, stack, parts, linked, in_link, at = [], Stack(), [], 0, False, 0
    tags = Tags(page)

    def flush():
        nonlocal parts, linked
        if parts:
            raw = "".join(parts)
            text = " ".join(html.unescape(raw).split())
            if text:
                blocks.append(Block(text, stack.top, min(1.0, linked / max(len(raw.strip()), 1))))
            parts, linked = [], 0

    def add(piece):
        nonlocal linked
        if piece:
            parts.append(piece)
            if in_link:
                linked += len(piece)

    while True:
        found = tags.next(at)
        if found is None:
            add(page[at:])
            break
        start, end, closing, name, attributes = found
        add(page[at:start])
        at = end
        if name is None:
            continue
        if name == "a":
            in_link = not closing
        elif name == "br":
            add(" ")
        elif name in RAW:
            if not closing and not attributes.endswith("/"):
                at = raw_end(page, name, at)[1]
        elif name in BLOCK:
            flush()
            if closing:
                in_link = False
                stack.close(name)
            else:
                stack.close_before(name)
                if name not in VOID:
                    around = stack.top.label if stack.top else 0
                    stack.push(name, attributes, label_of(attributes, around) if label_of else around)
                if name == "xmp":
                    # Its content is text as it stands.
                    stop, at = raw_end(page, name, end)
                    add(html.escape(page[end:stop], quote=False))
                    flush()
                    stack.close(name)
    flush()
    return blocks


def raw_end(page, name, at):
    """Where the content of an element ends that holds no tags, and where its end tag ends."""
    end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
    if not end:
        return len(page), len(page)
    stop = page.find(">", end.start())
    return end.start(), stop + 1 if stop >= 0 else len(page)
