"""Main text of web pages by wrappers inferred for each host.

A page becomes a stream of nested block tags and text slots. A wrapper is a union-free regular
expression over such streams: elements, text slots, repeated parts and optional parts. Each
page's stream is folded first (neighbours that are alike become one repeated part; a run in
which elements recur becomes one repeated group of optional members), so that it has few parts
however long the page is. The folded streams of all pages of a host are then aligned one after
another: parts that correspond merge, slot with slot and element with element, and what has no
counterpart becomes optional. Streams are merged in blocks ordered by hash, the results in
blocks again, so no task reads a whole host and the order of the input does not matter.

Each slot of the wrapper carries counts over all pages of the host: texts, unlinked characters,
and the smallest hashes of its texts, which tell how many differ. They label it:

* a slot whose texts hardly differ is the template's;
* other slots are content. Those in navigation, headers, footers, asides and forms are no main
  text, nor are those in containers outside of ``article`` and ``main`` with a furniture's name
  (the alignment cannot tell an advert that varies from an article). Within ``article`` and
  ``main`` only whole class names of comments and adverts count. Containers that hold nearly
  all of the host's varying text are main text whatever they are called.
* ``article`` and ``main`` go before other content, and the container with most of the host's
  varying text before the rest. Headings in an article are never the template's; neither is
  anything where the template would have half of the articles' text (nine tenths elsewhere).

Each page is matched to the wrapper, and its text is that of its slots with the best label.

Text is whole: character references are decoded, white space within a block is one
space, blocks are joined by a line feed. Inline tags do not end a block.

Wrappers are a table; those of the largest hosts, bounded in number, are broadcast, and
only pages of small hosts shuffle.

Defined cases: null or empty html gives an empty text; a null url counts as the host "";
pages may be cut anywhere, and open elements end there; elements nested deeper than ``DEPTH`` count as
parts of the element at that depth; rows that repeat an id are separate pages; columns other than
``page_id``, ``url`` and ``html`` may have any name. An empty table gives no rows.
"""

import functools
import hashlib
import html as entities
import json
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from telemere.llm.tables import join_groups, kept, map_arrow

#: Parts of an element that are aligned by place; longer lists become one repeated group of optional members.
LIST = 40
#: Nesting that is told apart.
DEPTH = 60
#: Hashes kept for each slot, the smallest: they estimate how many texts it has.
HASHES = 16
#: A slot is the template's when it has at least so many texts, and so many on average are the same.
LEAST_TEXTS = 3
SAME_TEXTS = 10
#: Folded streams that are merged in one task.
BLOCK = 64
#: Slots of the streams whose labels a task remembers.
KEPT_SLOTS = 100_000

# Elements that end a block, elements whose content is no text, and void elements (fixed values of HTML).
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section select summary table tbody td tfoot th thead title tr ul".split()
)
RAW = "script|style|noscript|template|textarea|iframe|svg|math|object|canvas|audio|video|xmp|noembed|noframes"
# Elements that end when one of the same group opens (fixed values of HTML).
SIBLINGS = [{"li"}, {"dt", "dd"}, {"tr"}, {"td", "th"}, {"option"}, {"thead", "tbody", "tfoot"}]
CLOSES_P = BLOCKS - {"body", "html", "head", "title", "option", "optgroup", "caption", "legend", "summary", "td", "th"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Elements that say nothing of their content: two of them are alike only by their parts.
GENERIC = {"div", "section", "table", "tbody", "tr", "td"}

FURNITURE = {"head", "title", "nav", "footer", "aside", "form", "menu", "select", "dialog", "fieldset", "button"}
FURNITURE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|sidebar|side|"
    r"comments?|disqus|replies|respond|share|sharing|social|menu|nav\w*|breadcrumbs?|foot|footer|header|masthead|"
    r"topbar|related|recommend\w*|newsletter|subscribe|signup|login|popup|modal|widget|pager|pagination|toc|"
    r"copyright|skip)(?:$|[\s_-])",
    re.I,
)
# Whole names that mark reader comments and adverts inside article and main.
INNER_NAMES = re.compile(
    r"(?:^|\s)(?:ads?|advert|advertisement|comments?|comments?[_-](?:list|section|area|thread|form)|disqus_thread|respond)(?:$|\s)",
    re.I,
)
# Elements around whole pages, whose names say nothing of a part, and furniture elements that can hold the page.
WHOLE = {"html", "body", "main", "article"}
OVERRULED = {"form", "fieldset", "dialog"}

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    # A quote is one only after an equals sign: elsewhere it is a character like others.
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>(?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")
# Slots by what they hold, and a repeated group of optional members.
TEXT, LINKS, GROUP = "#", "@", "+"


def host_of(url):
    """The host of a url column, in lower case; the empty text where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


@functools.lru_cache(maxsize=2_000)
def _label(name, attributes):
    """What an element is known by: its name, and its class, id and role with runs of digits as one 0."""
    if name in WHOLE or not attributes:
        return name
    named = " ".join(a or b or c for a, b, c in _NAMED.findall(attributes))
    return f"{name}.{_DIGITS.sub('0', _SPACE.sub(' ', named).strip())}" if named else name


def parsed(page):
    """A page as nested elements ``[label, parts]``, whose parts are elements and numbers of texts, and its texts

    with their unlinked characters: (parts, texts, unlinked).
    """
    root = ["", []]
    stack, parts, texts, unlinked = [("", root)], [], [], []
    opened, linked, in_link = Counter(), 0, False

    def flush():
        nonlocal parts, linked
        if parts:
            text = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
            if text:
                stack[-1][1][1].append(len(texts))
                texts.append(text)
                unlinked.append(max(0, len(text) - 2 * linked))
        parts, linked = [], 0

    def close(name):
        last = None
        while last != name:
            last, _ = stack.pop()
            opened[last] -= 1

    for token in _TOKEN.finditer(page):
        text = token["text"]
        if text is not None:
            parts.append(text)
            linked += len(text) if in_link else 0
            continue
        name = token["name"]
        if name is None:
            if token["raw"]:
                parts.append(" ")
            continue
        name = name.lower()
        if name == "a":
            in_link = not token["close"]
        elif name == "br":
            parts.append(" ")
        elif name in BLOCKS or name == "button":
            flush()
            in_link = False
            if token["close"]:
                if opened[name]:
                    close(name)
                continue
            if name in CLOSES_P and opened["p"]:
                close("p")
            for group in SIBLINGS:
                if name in group and stack[-1][0] in group:
                    close(stack[-1][0])
            if name == "hr":
                continue
            opened[name] += 1
            if len(stack) > DEPTH:
                stack.append((name, stack[-1][1]))
                continue
            node = [_label(name, token["attributes"]), []]
            stack[-1][1][1].append(node)
            stack.append((name, node))
    flush()
    return root[1], texts, unlinked


# Parts of folded streams and of wrappers: [label, repeated, optional, parts, held]. A slot holds the numbers of a
# page's texts, or counts over pages; elements and groups hold nothing.


def _labels(parts):
    found = set()
    for part in parts:
        if part[0] == GROUP:
            found |= _labels(part[3])
        else:
            found.add(part[0])
    return found


def alike(a, b):
    """Whether two parts are taken for the same part of a template."""
    if a[0] != b[0]:
        return False
    if a[0] == GROUP or a[0].partition(".")[0] in GENERIC:
        left, right = _labels(a[3]), _labels(b[3])
        return 2 * len(left & right) >= min(len(left), len(right))
    return True


def merged(a, b, join, repeated=False):
    """One part that matches what either of two parts with the same label matches."""
    if a[0] == GROUP:
        parts = a[3]
        for part in b[3]:
            parts = _absorbed(parts, part, join)
    else:
        parts = aligned(a[3], b[3], join)
    return [a[0], repeated or a[1] or b[1], a[2] or b[2], parts, join(a[4], b[4]) if a[0] in (TEXT, LINKS) else None]


def _absorbed(members, part, join):
    """Members of a group with one more part among them."""
    if part[0] == GROUP:
        for inner in part[3]:
            members = _absorbed(members, inner, join)
        return members
    if len(members) > 4 * LIST:
        part = [part[0].partition(".")[0], *part[1:]]
    for at, member in enumerate(members):
        if alike(member, part) or (len(members) > LIST and member[0] == part[0]):
            return [*members[:at], merged(member, part, join), *members[at + 1 :]]
    return [*members, [part[0], part[1], True, *part[3:]]]


def _grouped(parts, join):
    members = []
    for part in parts:
        members = _absorbed(members, part, join)
    return [GROUP, True, all(p[2] for p in parts), members, None]


def folded(parts, join):
    """A list of parts with neighbours that are alike as one, and a run in which parts recur as one group."""
    out = []
    for part in parts:
        place = next((at for at in range(len(out) - 1, -1, -1) if _takes(out[at], part)), None)
        if place is None:
            out.append(part)
        elif place == len(out) - 1 and out[place][0] != GROUP:
            out[place] = merged(out[place], part, join, repeated=True)
        else:
            out[place:] = [_grouped([*out[place:], part], join)]
        if len(out) > LIST:
            out = [_grouped(out, join)]
    return out


def _takes(part, other):
    """Whether ``other`` is one more of ``part``, or of a member of that group."""
    if part[0] == GROUP and other[0] != GROUP:
        return any(alike(member, other) for member in part[3])
    return alike(part, other)


def _likeness(a, b):
    if a[0] == b[0]:
        if alike(a, b):
            return 3
        return 0 if a[0] == GROUP or a[0] in GENERIC else 1
    if a[0] == GROUP or b[0] == GROUP:
        return 2 if _takes(a, b) or _takes(b, a) else 0
    return 0


def pairs(left, right):
    """Pairs of places of the best alignment of two lists of parts, None where one has no counterpart."""
    n, m = len(left), len(right)
    if [p[0] for p in left] == [p[0] for p in right] and len({p[0] for p in left}) == n:
        return [(i, i) for i in range(n)]
    like = [[_likeness(a, b) for b in right] for a in left]
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            here = best[i + 1][j + 1] + like[i][j] if like[i][j] else 0
            best[i][j] = max(here, best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and like[i][j] and best[i][j] == best[i + 1][j + 1] + like[i][j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif i < n and (j == m or best[i][j] == best[i + 1][j]):
            out.append((i, None))
            i += 1
        else:
            out.append((None, j))
            j += 1
    return out


def aligned(left, right, join):
    """The list of parts that matches what either of two lists matches."""
    out = []
    for i, j in pairs(left, right):
        if i is None or j is None:
            part = right[j] if i is None else left[i]
            out.append([part[0], part[1], True, *part[3:]])
        elif left[i][0] == right[j][0]:
            out.append(merged(left[i], right[j], join))
        else:
            out.append(_grouped([left[i], right[j]], join))
    return [_grouped(out, join)] if len(out) > LIST else out


def shape_of(parts, unlinked, texts):
    """The folded parts of a parsed page; elements without text are left out, slots hold numbers of texts."""
    out = []
    for part in parts:
        if isinstance(part, int):
            # A slot is one of links when most of its text is linked.
            out.append([TEXT if unlinked[part] or not texts[part] else LINKS, False, False, [], [part]])
        else:
            inner = shape_of(part[1], unlinked, texts)
            if inner:
                out.append([part[0], False, False, inner, None])
    return folded(out, _both)


def _both(a, b):
    a += b
    return a


def slots_of(parts, path=()):
    """(path, held) of each slot, in order."""
    for part in parts:
        if part[0] in (TEXT, LINKS):
            yield path, part[4]
        else:
            yield from slots_of(part[3], path if part[0] == GROUP else (*path, part[0]))


def _outline(parts):
    return [[p[0], p[1], p[2], _outline(p[3]), None] for p in parts]


def _filled(parts, held):
    """``parts`` whose slots hold the next of ``held`` each."""
    return [[p[0], p[1], p[2], _filled(p[3], held), next(held) if p[0] in (TEXT, LINKS) else None] for p in parts]


def joined_counts(a, b):
    """Counts of a slot over the pages of both: [texts, unlinked, characters, [[hash, texts], ...]]."""
    hashes = dict(a[3])
    for value, n in b[3]:
        hashes[value] = hashes.get(value, 0) + n
    return [a[0] + b[0], a[1] + b[1], a[2] + b[2], [[h, hashes[h]] for h in sorted(hashes)[:HASHES]]]


def align(shapes):
    """The wrapper of folded streams whose slots hold counts."""
    wrapper = shapes[0]
    for parts in shapes[1:]:
        wrapper = aligned(wrapper, parts, joined_counts)
    return wrapper


def distinct(hashes):
    """How many texts a slot has, by the smallest of their hashes, which lie evenly in 63 bits."""
    if len(hashes) < HASHES:
        return len(hashes)
    return (HASHES - 1) * 2.0**63 / max(1, hashes[HASHES - 1][0])


# Labels: what a slot is for the main text, the best last.
OUT, OTHER, MOST, ARTICLE = range(4)


@functools.lru_cache(maxsize=10_000)
def vetoed(container, inside):
    """Whether what stands in a container is furniture, and whether the host's text can show otherwise."""
    name, _, named = container.partition(".")
    if name in WHOLE:
        return False, False
    if name in FURNITURE or (name == "header" and not inside):
        return True, name in OVERRULED
    names = INNER_NAMES if inside else FURNITURE_NAMES
    return bool(named and names.search(named)), True


def furniture(path, opened=frozenset()):
    """The length of the path up to its first container that makes a slot furniture, else 0.

    ``opened`` are paths of containers that hold the host's text whatever they are called.
    """
    inside = False
    for at, container in enumerate(path):
        veto, _ = vetoed(container, inside)
        if veto and path[: at + 1] not in opened:
            return at + 1
        inside = inside or container.partition(".")[0] in ("article", "main")
    return 0


def opened_by(weights):
    """Paths of vetoed containers that hold nearly all text, as ``weights`` (path -> unlinked varying text) shows.

    A name cannot make nearly all of a host's text furniture: while less than a tenth stands
    outside of furniture, the vetoed container with more than half of the text is opened.
    """
    total, opened = sum(weights.values()), set()
    while total:
        shut = {}
        for path, weight in weights.items():
            at = furniture(path, opened)
            if at:
                shut[path[:at]] = shut.get(path[:at], 0) + weight
        if total - sum(shut.values()) >= total / 10:
            break
        path = max(shut, key=lambda c: (shut[c], c))
        inside = in_article(path[:-1])
        if 2 * shut[path] <= total or not vetoed(path[-1], inside)[1]:
            break
        opened.add(path)
    return opened


def in_article(path):
    return any(c.partition(".")[0] in ("article", "main") for c in path)


def _top(weights):
    """The innermost container that holds more than half of the text."""
    sums = {}
    for path, weight in weights.items():
        for at in range(len(path)):
            sums[path[:at]] = sums.get(path[:at], 0) + weight
    half = sum(weights.values()) / 2
    return max((c for c in sums if sums[c] > half), key=lambda c: (len(c), c), default=())


def _weights(slots, used):
    weights = {}
    for at in used:
        path, (_, unlinked, *_) = slots[at]
        weights[path] = weights.get(path, 0) + unlinked
    return weights


def labels_of(wrapper):
    """The label of each slot of a wrapper with counts, in order."""
    slots = list(slots_of(wrapper))
    every = range(len(slots))
    same = {
        at for at in every if slots[at][1][0] >= LEAST_TEXTS and SAME_TEXTS * distinct(slots[at][1][3]) <= max(SAME_TEXTS, slots[at][1][0])
    }
    varying = [at for at in every if at not in same]
    opened = opened_by(_weights(slots, varying or every))
    free = [at for at in every if not furniture(slots[at][0], opened)]
    article = [at for at in free if in_article(slots[at][0])]
    rest = [at for at in free if not in_article(slots[at][0])]

    def content(group, most, named):
        """The slots of a group that are not the template's, if the template has not most of its text."""
        fixed = {at for at in group if at in same and not (named and _heading(slots[at][0]))}
        sizes = {at: slots[at][1][2] for at in group}
        if sum(sizes[at] for at in fixed) >= most * sum(sizes.values()):
            return group
        return [at for at in group if at not in fixed]

    labels = [OUT] * len(slots)
    rest = content(rest, 0.9, False)
    top = _top(_weights(slots, rest))
    for at in rest:
        labels[at] = MOST if slots[at][0][: len(top)] == top else OTHER
    for at in content(article, 0.5, True):
        labels[at] = ARTICLE
    return labels


def _heading(path):
    return bool(path) and path[-1].partition(".")[0] in HEADINGS


def matched(wrapper, parts):
    """What the wrapper's slots hold for each text of a page: pairs of (held, numbers of texts).

    ``held`` is None where the wrapper has no counterpart.
    """
    for i, j in pairs(wrapper, parts):
        if j is not None:
            yield from _matched_part(wrapper[i] if i is not None else None, parts[j])


def _matched_part(own, part):
    if part[0] in (TEXT, LINKS):
        slot = own
        if own is not None and own[0] == GROUP:
            slot = next((m for m in own[3] if m[0] == part[0]), None)
        yield (slot[4] if slot is not None and slot[0] == part[0] else None), part[4]
    elif own is None:
        for _, held in slots_of([part]):
            yield None, held
    elif part[0] == GROUP:
        for member in part[3]:
            if own[0] == GROUP:
                yield from _matched_part(own, member)
            else:
                yield from _matched_part(own if alike(own, member) else None, member)
    elif own[0] == GROUP:
        yield from _matched_part(_member(own[3], part), part)
    elif own[0] == part[0] or own[0] == part[0].partition(".")[0]:
        yield from matched(own[3], part[3])
    else:
        yield from _matched_part(None, part)


def _member(members, part):
    """The member of a group that stands for a part: alike, else with its label, else with its name alone."""
    name = part[0].partition(".")[0]
    for test in (lambda m: alike(m, part), lambda m: m[0] == part[0], lambda m: m[0] == name):
        found = next((m for m in members if test(m)), None)
        if found is not None:
            return found
    return None


def text_hash(text):
    """63 bits that stand for a text."""
    digest = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8)
    return int.from_bytes(digest.digest(), "big") >> 1


def shape_key(outline):
    return text_hash(outline) - (1 << 62)


def page_shape(page):
    """(folded parts, their outline as text, texts, unlinked characters) of a page."""
    parts, texts, unlinked = parsed(page or "")
    shape = shape_of(parts, unlinked, texts)
    return shape, json.dumps(_outline(shape), separators=(",", ":")), texts, unlinked


def counted(page):
    """A page as a folded stream whose slots hold counts."""
    shape, _, texts, unlinked = page_shape(page)
    held = iter([_page_counts(numbers, texts, unlinked) for _, numbers in slots_of(shape)])
    return _filled(shape, held)


def _page_counts(numbers, texts, unlinked):
    hashes = {text_hash(texts[i]) for i in numbers}
    sizes = sum(unlinked[i] for i in numbers), sum(len(texts[i]) for i in numbers)
    return [len(hashes), *sizes, [[h, 1] for h in sorted(hashes)[:HASHES]]]


def spec(wrapper):
    """What a Reader needs of a wrapper with counts: the wrapper whose slots hold labels."""
    return _filled(wrapper, iter(labels_of(wrapper)))


def infer(pages):
    """The wrapper of a host, with labels, from the html of its pages."""
    return spec(align([counted(p) for p in pages]))


class Reader:
    """Reads pages by the wrappers of their hosts, and remembers the labels of the streams it met."""

    def __init__(self):
        self.specs, self.known, self.slots = {}, {}, 0

    def labels(self, own, shape, outline):
        key = (own, shape_key(outline))
        if key not in self.known:
            if own not in self.specs:
                if len(self.specs) >= 200:
                    self.specs.clear()
                self.specs[own] = json.loads(own)
            found = {numbers[0]: label for label, numbers in matched(self.specs[own], shape)}
            labels = [(path, found[numbers[0]]) for path, numbers in slots_of(shape)]
            # What has no counterpart is judged by its own containers.
            known = all(label is not None for _, label in labels)
            labels = [(p, _lone_label(p) if label is None else label) for p, label in labels]
            if self.slots >= KEPT_SLOTS:
                self.known.clear()
                self.slots = 0
            self.known[key] = labels, known
            self.slots += len(labels) + 1
        return self.known[key]

    def read(self, own, page):
        """Main text of a page by the wrapper ``own`` (JSON), and whether the wrapper matches it."""
        shape, outline, texts, unlinked = page_shape(page)
        labels, known = self.labels(own, shape, outline)
        best = max((label for _, label in labels), default=OUT)
        slots = [(path, numbers) for (path, label), (_, numbers) in zip(labels, slots_of(shape), strict=True) if label == best]
        if best == OTHER:
            weights = {}
            for path, numbers in slots:
                weights[path] = weights.get(path, 0) + sum(unlinked[i] for i in numbers)
            top = _top(weights)
            slots = [(p, n) for p, n in slots if p[: len(top)] == top]
        chosen = [] if best == OUT else sorted(i for _, numbers in slots for i in numbers)
        return "\n".join(texts[i] for i in chosen), known


def _lone_label(path):
    if furniture(path):
        return OUT
    return ARTICLE if in_article(path) else OTHER


COUNTS = pa.schema(
    [
        ("host", pa.string()),
        ("shape", pa.int64()),
        ("slot", pa.int32()),
        ("mark", pa.int64()),
        ("outline", pa.string()),
        ("n", pa.int64()),
        ("unlinked", pa.int64()),
        ("size", pa.int64()),
    ]
)


def _count_rows(batches):
    """Counts of each batch: for each host and folded stream its outline and pages (slot -1), for each slot

    the texts and characters, and for the smallest hashes of texts there the texts.
    """
    for batch in batches:
        outlines, found = {}, {}
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            shape, outline, texts, unlinked = page_shape(page)
            key = (host, shape_key(outline))
            outlines[key] = (outline, outlines.get(key, (None, 0))[1] + 1)
            now = [_page_counts(numbers, texts, unlinked) for _, numbers in slots_of(shape)]
            before = found.get(key)
            found[key] = [joined_counts(a, b) for a, b in zip(before, now, strict=True)] if before else now
        rows = []
        for (host, shape), (outline, pages) in outlines.items():
            rows.append((host, shape, -1, None, outline, pages, 0, 0))
            for slot, (texts, unlinked, size, hashes) in enumerate(found[host, shape]):
                rows.append((host, shape, slot, None, None, texts, unlinked, size))
                rows.extend((host, shape, slot, h, None, n, 0, 0) for h, n in hashes)
        columns = zip(*rows, strict=True) if rows else [()] * len(COUNTS)
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, COUNTS, strict=True)], schema=COUNTS)


def shape_counts(pages):
    """host, shape, pages, outline and slots (their counts) of each folded stream of each host."""
    schema = "host string, shape long, slot int, mark long, outline string, n long, unlinked long, size long"
    rows = map_arrow(pages.select(host_of(F.col("url")).alias("host"), "html"), _count_rows, schema)
    sums = rows.groupBy("host", "shape", "slot", "mark").agg(
        F.min("outline").alias("outline"), *[F.sum(c).alias(c) for c in ("n", "unlinked", "size")]
    )
    counts = kept(sums, "slots")
    least = Window.partitionBy("host", "shape", "slot").orderBy("mark")
    marks = (
        counts.filter("mark IS NOT NULL")
        .withColumn("rank", F.row_number().over(least))
        .filter(F.col("rank") <= HASHES)
        .select("host", "shape", "slot", "mark", "n", "unlinked", "size")
    )
    # A stream has few slots, so its lists are short.
    held = counts.filter("mark IS NULL AND slot >= 0").select("host", "shape", "slot", "mark", "n", "unlinked", "size")
    lists = held.unionByName(marks).groupBy("host", "shape").agg(
        F.collect_list(F.struct("slot", "mark", "n", "unlinked", "size")).alias("slots")
    )
    heads = counts.filter("slot = -1").select("host", "shape", F.col("n").alias("pages"), "outline")
    return heads.join(lists, ["host", "shape"], "left")


def _with_counts(outline, rows):
    held = {}
    for row in rows if isinstance(rows, (list, np.ndarray)) else ():
        counts = held.setdefault(row["slot"], [0, 0, 0, []])
        if row["mark"] is None:
            counts[:3] = [int(row["n"]), int(row["unlinked"]), int(row["size"])]
        else:
            counts[3].append([int(row["mark"]), int(row["n"])])
    for counts in held.values():
        counts[3].sort()
    return _filled(json.loads(outline), iter([held[slot] for slot in sorted(held)]))


def _first_block(pdf):
    """One wrapper with counts of the streams of a block."""
    pdf = pdf.sort_values("shape")
    wrapper = align([_with_counts(o, s) for o, s in zip(pdf["outline"], pdf["slots"], strict=True)])
    return pdf.iloc[:1].assign(wrapper=json.dumps(wrapper), pages=pdf["pages"].sum())[["host", "shape", "pages", "wrapper"]]


def _next_block(pdf):
    pdf = pdf.sort_values("shape")
    wrapper = align([json.loads(w) for w in pdf["wrapper"]])
    return pdf.iloc[:1].assign(wrapper=json.dumps(wrapper), pages=pdf["pages"].sum())[["host", "shape", "pages", "wrapper"]]


def _specs(batches):
    for batch in batches:
        own = [json.dumps(spec(json.loads(w)), separators=(",", ":")) for w in batch.column(2).to_pylist()]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(own, pa.string())], names=["host", "pages", "wrapper"])


def wrappers(pages):
    """host, pages (how many it has) and wrapper (JSON, with the labels of its slots) of each host."""
    schema = "host string, shape long, pages long, wrapper string"

    def blocks(rows, merge):
        """Rows of a host merged in blocks of about ``BLOCK``, dealt by their hashes."""
        sizes = rows.groupBy("host").agg(F.count(F.lit(1)).alias("count"))
        most, total = sizes.agg(F.max("count"), F.sum("count")).first()
        most = most or 0
        wide = sizes.withColumn("blocks", F.ceil(F.col("count") / BLOCK))
        dealt = join_groups(rows, wide, "host", "count", total or 0)
        block = F.pmod(F.xxhash64("shape", F.lit(most)), F.col("blocks")).alias("block")
        merged_rows = dealt.withColumn("block", block).groupBy("host", "block").applyInPandas(merge, schema)
        return kept(merged_rows, "wrappers"), most

    rows, most = blocks(kept(shape_counts(pages), "shapes"), _first_block)
    while most > BLOCK:
        rows, most = blocks(rows, _next_block)
    return kept(map_arrow(rows.select("host", "pages", "wrapper"), _specs, "host string, pages long, wrapper string"), "labelled")


def extract(pages):
    """One row per page: page_id, url, text, n_chars, matched."""
    found = wrappers(pages)
    total = found.agg(F.sum("pages")).first()[0] or 0
    rows = pages.select(F.col("page_id").cast("long"), "url", "html", host_of(F.col("url")).alias("host"))
    joined = join_groups(rows, found, "host", "pages", total).select("page_id", "url", "html", "wrapper")
    schema = "page_id long, url string, text string, n_chars long, matched boolean"

    def run(batches):
        reader = Reader()
        for batch in batches:
            texts, sizes, whole = [], [], []
            for page, own in zip(batch.column(2), batch.column(3), strict=True):
                text, matches = reader.read(own.as_py(), page.as_py())
                texts.append(text)
                sizes.append(len(text))
                whole.append(matches)
            yield pa.record_batch(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array(sizes, pa.int64()),
                    pa.array(whole, pa.bool_()),
                ],
                names=["page_id", "url", "text", "n_chars", "matched"],
            )

    return map_arrow(joined, run, schema)
