"""Main text of web pages by union-free regular-expression inference over pages of one host.

A page becomes a tree of block elements (phrase-level tags belong to the text around them, missing end tags are implied).
The wrapper of a host is a union-free regular expression over such trees: items that occur once, optionally,
repeatedly, repeated groups of items, and text slots. It is inferred by folding the host's pages one after the other:
equal neighbours and equal neighbouring groups of a page fold into repeats, then page and wrapper are aligned (a longest common
subsequence by bit vectors); matched items are merged recursively, a text that differs becomes a slot, and what only one side has
becomes optional.

Once a host's wrapper stands, all its pages are read by it and counted: which text each slot shows on how many distinct pages.
A signature is made of the texts that hold four fifths of a page, so copies of one page, and copies that differ in a counter or a
date, are one page here. A text that a slot shows on at least ``SHARE`` of the host's distinct
pages, and on ``LEAST_PAGES`` of them, belongs to the template and is left out, wherever it stands and whatever its element is
called; so menus, notices and calls to subscribe go without a telling class. Element and class names are the prior: where the host has article or
main elements, main text lies inside them; and not inside menus, footers, sidebars, forms and the like, named by their
element or by a class all of whose words say so (``ad-banner``, but not ``side-effects``), unless all of the host's main elements lie in them.
What else varies or is rare is main text. A page is read by aligning it with its host's wrapper and writing out, in page order, one
line per block.

Scale: wrappers are folded inside each task first, then ``FAN_IN`` tasks at a time in a tree, so a host with a third of all pages is
a few small wrappers per task and no page leaves its partition. The counts of slot texts are two partially aggregated group-bys over
(host, text, signature) hashes, so a host's pages spread over all tasks. Decisions are made once a host, and pages get them by a join on
host, broadcast only when their measured size is small. Aligning two lists of n and m items takes n * m bits and little more than
n + m steps of big integers; lists beyond ``ALIGN_BITS`` are aligned in stretches.

Edge cases: null or empty html gives an empty text. A null url, or one without ``://``, belongs to the host "". Unclosed
and stray tags, comments and scripts never fail; elements below ``MAX_DEPTH`` become neighbours, and very long pages are read whole.
A host of fewer than ``LEAST_PAGES`` distinct pages has no template texts. Repeated pages give equal rows. An empty table gives no
rows. Only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import html
import json
import re
from itertools import count

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prelaunch.llm.components import shared_checkpoint

BROADCAST_BYTES = 32 << 20
FAN_IN = 32
SHARE = 0.8                  # of a host's distinct pages, that show a text of the template
LEAST_PAGES = 3
ALIGN_BITS = 1 << 30
MAX_DEPTH = 150              # deeper elements become neighbours of the deepest ones; their text stays
HELD_HOSTS = 2_000           # wrappers a task holds before it passes them on

# Element names by role.
PHRASE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base col embed hr input link meta param source track".split())
RAW = set("script style noscript template iframe textarea title svg object audio video canvas select".split())
FURNITURE = set("nav footer aside form button menu dialog fieldset label".split())
# Class, id and role words that mark furniture.
FURNITURE_WORDS = set((
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notification alert popup modal overlay sidebar side rail menu nav navbar navigation breadcrumb breadcrumbs footer foot comment "
    "comments commentlist disqus reply replies respond share sharing social related recommended recommendations newsletter subscribe "
    "subscription signup login search searchform widget pagination pager toolbar copyright contentinfo complementary").split())
HEADER_WORDS = {"header", "masthead", "topbar"}
# Words that say nothing beside one of those.
NEUTRAL_WORDS = set("area bar block bottom box container content inner item left link links list main module outer page panel post region right section site top wrap wrapper".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)|[^<]+|<", re.S)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)


class Node:
    __slots__ = ("tag", "label", "children")

    def __init__(self, tag: str, label: str):
        self.tag, self.label, self.children = tag, label, []   # children: nodes and texts


def parse(page: str) -> Node:
    """The body's block tree; a text child is all text between two block tags, references decoded, spaces folded."""
    root = Node("body", "body")
    stack, buffer = [root], []
    deep: dict[str, int] = {}                  # open elements below MAX_DEPTH, which are not on the stack
    at, n = 0, len(page)

    def flush():
        text = " ".join(html.unescape("".join(buffer)).split()) if buffer else ""
        buffer.clear()
        if text:
            stack[-1].children.append(text)

    while at < n:
        m = _TOKEN.match(page, at)
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            if m[0][0] != "<" or m[0] == "<":
                buffer.append(m[0])
            continue
        closing, tag, rest = m[1] or m[4], name.lower(), m[3] or m[6] or ""
        if tag in RAW and not closing and not rest.endswith("/"):
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in PHRASE:
            if tag in ("br", "img"):
                buffer.append(" ")
            continue
        if tag in ("html", "head", "body") or tag in RAW:
            continue
        if tag in VOID:
            flush()
            continue
        flush()
        if closing and deep.get(tag):
            deep[tag] -= 1
            continue
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        # a block ends an open paragraph; list items, cells and the like end their kind
        while len(stack) > 1 and stack[-1].tag == "p":
            stack.pop()
        if tag in CLOSES:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in SCOPE[tag]:
                    break
                if stack[i].tag in CLOSES[tag]:
                    del stack[i:]
                    break
        names = sorted({w for _, v in _NAMES.findall(rest) for w in (re.sub(r"[^a-z]+", "-", t).strip("-") for t in v.lower().split()) if w}) if rest else []
        node = Node(tag, ".".join([tag, *names]))
        stack[-1].children.append(node)
        if not rest.endswith("/"):
            if len(stack) < MAX_DEPTH:
                stack.append(node)
            else:
                deep[tag] = deep.get(tag, 0) + 1
    flush()
    return root


def text_hash(text: str) -> str:
    return xxhash.xxh64_hexdigest(text)[:12]


def texts_of(node: Node) -> list[str]:
    out, todo = [], [node]
    while todo:
        for child in todo.pop().children:
            out.append(child) if isinstance(child, str) else todo.append(child)
    return out


def signature(page: Node) -> str:
    """A hash of the longest texts that hold four fifths of the page's characters."""
    texts = sorted(texts_of(page), key=lambda t: (-len(t), t))
    whole, held, own = sum(map(len, texts)), 0, []
    for t in texts:
        if 5 * held >= 4 * whole:
            break
        own.append(text_hash(t))
        held += len(t)
    return text_hash(" ".join(sorted(own)))


# A wrapper item is a list [label, quantifier, value, children]. Labels: "#" for text (value: the constant text's hash, or None
# for a slot), "()" for a group, else an element. Quantifiers: "1", "?", "+", "*". In place of children a text has marks,
# "<text hash>:<page signature>": which page showed what there. Wrappers of whole tables are folded without marks; there Spark
# counts what the slots show.


class Marks(dict):
    """A set of marks that reads like a list of items."""

    def __iter__(self):
        return iter([[m, "", None, []] for m in self.keys()])


def _key(item) -> str:
    return "(" + " ".join(map(_key, item[3])) + ")" if item[0] == "()" else item[0]


def items_of(node: Node, page: str | None = None, deep: bool = True) -> tuple[list, list]:
    """The node's children as wrapper items with repeats folded, and for each item the children it stands for. Texts are
    marked with the signature ``page``, if given. Without ``deep`` only this level is looked at."""
    items, own = [], []
    for child in node.children:
        if isinstance(child, str):
            h = text_hash(child)
            item = ["#", "1", h, Marks({f"{h}:{page}": None}) if page else []]
        else:
            item = [child.label, "1", None, items_of(child, page)[0] if deep else []]
        if items and items[-1][0] == item[0]:
            items[-1] = merge(items[-1], item)
            items[-1][1] = "+"
            own[-1].append(child)
        else:
            items.append(item)
            own.append([child])
    return fold_groups(items, own)


def fold_groups(items: list, own: list) -> tuple[list, list]:
    """Neighbouring equal groups of two to four items become one repeated group."""
    for size in (2, 3, 4):
        i = 0
        while i + 2 * size <= len(items):
            keys = [_key(x) for x in items[i: i + size]]
            count = 1
            while [_key(x) for x in items[i + count * size: i + (count + 1) * size]] == keys:
                count += 1
            if count > 1:
                body = items[i: i + size]
                for c in range(1, count):
                    body = [merge(a, b) for a, b in zip(body, items[i + c * size: i + (c + 1) * size])]
                members = [x for y in own[i: i + count * size] for x in y]
                items[i: i + count * size] = [["()", "+", None, body]]
                own[i: i + count * size] = [members]
            i += 1
    return items, own


def merge(a: list, b: list) -> list:
    """The smallest item that covers two items of one label; the first one's marks are taken over."""
    many = a[1] in "+*" or b[1] in "+*"
    maybe = a[1] in "?*" or b[1] in "?*"
    quantifier = ("*" if maybe else "+") if many else ("?" if maybe else "1")
    if a[0] == "#":
        marks = a[3] or b[3]
        if a[3] and b[3]:
            marks.update(b[3])
        return ["#", quantifier, a[2] if a[2] == b[2] else None, marks]
    return [a[0], quantifier, None, align(a[3], b[3])]


def pairs(a: list, b: list) -> list[tuple[int, int]]:
    """A longest common subsequence of two item lists, by label."""
    ka, kb = [_key(x) for x in a], [_key(x) for x in b]
    if ka == kb:
        return list(zip(range(len(ka)), range(len(kb))))
    first = 0
    while first < min(len(ka), len(kb)) and ka[first] == kb[first]:
        first += 1
    last = 0
    while last < min(len(ka), len(kb)) - first and ka[-1 - last] == kb[-1 - last]:
        last += 1
    out = [(i, i) for i in range(first)]
    ma, mb = ka[first: len(ka) - last], kb[first: len(kb) - last]
    stretches = max(1, -(-len(ma) * len(mb) // ALIGN_BITS))
    for t in range(stretches):
        x, y = len(ma) * t // stretches, len(mb) * t // stretches
        found = common(ma[x: len(ma) * (t + 1) // stretches], mb[y: len(mb) * (t + 1) // stretches])
        out += [(first + x + i, first + y + j) for i, j in found]
    return out + [(len(ka) - k, len(kb) - k) for k in range(last, 0, -1)]


def common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """A longest common subsequence by bit vectors: bit j of row i is 0 where the length grows from b[:j] to b[:j + 1]."""
    where: dict[str, int] = {}
    for j, k in enumerate(b):
        where[k] = where.get(k, 0) | 1 << j
    full = (1 << len(b)) - 1
    rows = [full]
    for k in a:
        v = rows[-1]
        u = v & where.get(k, 0)
        rows.append(((v + u) | (v - u)) & full)
    out, i, j = [], len(a), len(b)
    while i and j:
        # columns at which this row does not grow lead nowhere
        j = (~rows[i] & ((1 << j) - 1)).bit_length()
        if not j:
            break
        while not rows[i - 1] >> (j - 1) & 1:
            i -= 1
        out.append((i - 1, j - 1))
        i, j = i - 1, j - 1
    return out[::-1]


def group_alike(a: list, b: list) -> list:
    """``b`` with every stretch that spells a group of ``a`` turned into that group; where several fit, into the first."""
    groups: dict[str, dict[tuple, None]] = {}
    for x in a:
        if x[0] == "()":
            keys = tuple(map(_key, x[3]))
            groups.setdefault(keys[0], {})[keys] = None
    if not groups:
        return b
    spelled, out, i = list(map(_key, b)), [], 0
    while i < len(b):
        for keys in groups.get(spelled[i], ()):
            if tuple(spelled[i: i + len(keys)]) == keys:
                out.append(["()", "1", None, b[i: i + len(keys)]])
                i += len(keys)
                break
        else:
            out.append(b[i])
            i += 1
    return out


def optional(item: list) -> list:
    return [item[0], {"1": "?", "+": "*"}.get(item[1], item[1]), *item[2:]]


def align(a: list, b: list) -> list:
    """The item list that covers two lists: matched items merge, the others become optional."""
    a, b = group_alike(b, a), group_alike(a, b)
    out, i, j = [], 0, 0
    for x, y in [*pairs(a, b), (len(a), len(b))]:
        out += [optional(t) for t in a[i:x]] + [optional(t) for t in b[j:y]]
        if x < len(a) and y < len(b):
            out.append(merge(a[x], b[y]))
        i, j = x + 1, y + 1
    return out


def infer(wrapper: list | None, page: str, marked: bool = True) -> list:
    """The wrapper that also covers one more page. It remembers which page showed which text, unless ``marked`` is false."""
    node = parse(page or "")
    items = items_of(node, signature(node) if marked else None)[0]
    return items if wrapper is None else align(wrapper, items)


def marks_of(items: list) -> set[str]:
    """Signatures of the pages that the wrapper remembers."""
    out: set[str] = set()
    for label, _, _, children in items:
        out |= ({m.split(":")[1] for m in children.keys()} if children else set()) if label == "#" else marks_of(children)
    return out


def is_furniture(tag: str, label: str, inside: bool) -> bool:
    """Whether the element's name says that it holds no main text: its tag, or a class all of whose words say so."""
    if tag in FURNITURE:
        return True
    for name in label.split(".")[1:]:
        words = set(name.split("-"))
        if words & FURNITURE_WORDS and words <= FURNITURE_WORDS | NEUTRAL_WORDS:
            return True
        if not inside and words & HEADER_WORDS and words <= HEADER_WORDS | NEUTRAL_WORDS:
            return True
    return not inside and tag == "header"


def is_main(label: str) -> bool:
    parts = label.split(".")
    return parts[0] in ("article", "main") or bool({"main", "article"} & set(parts[1:]))


def mains(items: list) -> int:
    """Main elements outside of furniture elements."""
    return sum(mains(c) if l == "()" else int(is_main(l)) + mains(c) if l != "#" and l.split(".")[0] not in FURNITURE else 0 for l, _, _, c in items)


def mark(items: list) -> list:
    """The wrapper with every text slot's decision (True: main text) in place of its value, with the hashes of its template
    texts, as far as it remembers pages, in place of its marks, and with the slot's number."""
    whole, pages, slots = mains(items), len(marks_of(items)), count()
    least = max(LEAST_PAGES, SHARE * pages)

    def template(marks) -> list:
        seen: dict[str, set] = {}
        for m in marks.keys() if marks else ():
            text, page = m.split(":")
            seen.setdefault(text, set()).add(page)
        return sorted(t for t, own in seen.items() if len(own) >= least)

    def walk(items, inside, out_of_it):
        out = []
        for label, q, _, children in items:
            if label == "#":
                out.append([label, q, not out_of_it and (inside or not whole), template(children), next(slots)])
                continue
            here = out_of_it
            if label != "()" and not here:
                tag = label.split(".")[0]
                # a class says little against an element that holds all of the host's main elements
                around = whole and tag not in FURNITURE and mains(children) + is_main(label) == whole
                here = is_furniture(tag, label, inside) and not around
            out.append([label, q, None, walk(children, inside or (label != "()" and is_main(label)), here)])
        return out

    return walk(items, False, False)


def main_texts(marked: list, page: Node) -> list[tuple[int, str]]:
    """The texts of a page in the wrapper's main slots, in page order, with their slots' numbers."""
    out: list[tuple[int, str]] = []

    def read(items: list, node: Node) -> None:
        found, own = items_of(node, deep=False)
        matched = {y: items[x] for x, y in pairs(items, found)}
        by_label: dict[str, list] = {}               # for what a group or repeat holds
        for s in flat(items):
            by_label.setdefault(s[0], s)
        for y, members in enumerate(own):
            for child in members:
                label = "#" if isinstance(child, str) else child.label
                slot = matched.get(y)
                if slot is None or slot[0] != label:
                    slot = by_label.get(label)
                if isinstance(child, str):
                    if slot is not None and slot[2] and not (slot[3] and text_hash(child) in slot[3]):
                        out.append((slot[4], child))
                elif slot is not None:
                    read(slot[3], child)

    read(marked, page)
    return out


def slot_text(slot: int, text: str) -> int:
    """A hash of what a slot shows, as a signed long."""
    return xxhash.xxh64_intdigest(f"{slot}:{text}") - (1 << 63)


def extract(marked: list, page: str, template: frozenset[int] = frozenset()) -> str:
    """Main text of a page: its blocks in the wrapper's main slots, in page order, without the template's texts."""
    return "\n".join(text for slot, text in main_texts(marked, parse(page or "")) if not template or slot_text(slot, text) not in template)


def flat(items: list) -> list:
    """Items with groups opened."""
    out = []
    for x in items:
        out += flat(x[3]) if x[0] == "()" else [x]
    return out


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; "" without ://."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper, n_pages): the marked wrapper of every host as JSON."""

    def fold(batches):
        held: dict[str, tuple[list, int]] = {}

        def rows():
            part = TaskContext.get().partitionId() if TaskContext.get() else 0
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array([part] * len(held), pa.int32()),
                 pa.array([json.dumps(w) for w, _ in held.values()], pa.string()), pa.array([n for _, n in held.values()], pa.int64())],
                ["host", "part", "wrapper", "n_pages"])
            held.clear()
            return batch

        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                w, n = held.get(host, (None, 0))
                held[host] = (infer(w, page, False), n + 1)
                if len(held) > HELD_HOSTS:
                    yield rows()
        yield rows()

    def join(table: pa.Table, last: bool) -> pa.Table:
        w = None
        for x in table.column("wrapper").to_pylist():
            w = json.loads(x) if w is None else align(w, json.loads(x))
        return pa.table({"host": table.column("host")[:1], "part": pa.array([table.column("part")[0].as_py() // FAN_IN], pa.int32()),
                         "wrapper": pa.array([json.dumps(mark(w) if last else w)], pa.string()), "n_pages": pa.array([sum(table.column("n_pages").to_pylist())], pa.int64())})

    kind = "host string, part int, wrapper string, n_pages long"
    parts = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(fold, kind)
    for _ in range(2):
        parts = parts.groupBy("host", F.floor(F.col("part") / FAN_IN).alias("up")).applyInArrow(lambda t: join(t, False), kind)
    return parts.groupBy("host").applyInArrow(lambda t: join(t, True), kind).select("host", "wrapper", "n_pages")


class Wrappers:
    """Wrappers by their JSON, read once as long as they are held."""

    def __init__(self):
        self.held: dict = {}

    def __call__(self, key, read):
        if key not in self.held:
            if len(self.held) > 1_000:
                self.held.clear()
            self.held[key] = read()
        return self.held[key]


def with_wrapper(pages: DataFrame, wrappers: DataFrame, small: bool) -> DataFrame:
    return pages.join(F.broadcast(wrappers) if small else wrappers, "w_host", "left")


def template_texts(pages: DataFrame, wrappers: DataFrame, small: bool) -> DataFrame:
    """(w_host, template): for every host the hashes of the slot texts that nearly all its distinct pages show, counted over all
    pages (``w_host``, ``html``). The table is empty for hosts without any."""

    def shown(batches):
        wrapper = Wrappers()
        for batch in batches:
            hosts, texts, signs = [], [], []
            for host, w, page in zip(*(batch.column(c).to_pylist() for c in ("w_host", "wrapper", "html"))):
                tree = parse(page or "")
                own = {slot_text(slot, text) for slot, text in main_texts(wrapper(w, lambda: json.loads(w)), tree)}
                hosts += [host] * (len(own) + 1)
                texts += [None, *own]               # a row without a text counts the page itself
                signs += [xxhash.xxh64_intdigest(signature(tree)) - (1 << 63)] * (len(own) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(texts, pa.int64()), pa.array(signs, pa.int64())], ["w_host", "text", "sign"])

    seen = with_wrapper(pages.select("w_host", "html"), wrappers, small).select("w_host", "wrapper", "html").mapInArrow(shown, "w_host string, text long, sign long")
    counts = seen.distinct().groupBy("w_host", "text").agg(F.count(F.lit(1)).alias("n"))
    counts = shared_checkpoint(counts.where(F.col("text").isNull() | (F.col("n") >= LEAST_PAGES)))
    whole = counts.where(F.col("text").isNull()).select("w_host", F.col("n").alias("n_pages"))
    often = counts.where(F.col("text").isNotNull()).join(whole, "w_host").where(F.col("n") >= F.greatest(F.lit(float(LEAST_PAGES)), SHARE * F.col("n_pages")))
    return often.groupBy("w_host").agg(F.array_sort(F.collect_list("text")).alias("template"))


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html)."""
    wrappers = shared_checkpoint(infer_wrappers(pages)).select(F.col("host").alias("w_host"), "wrapper")
    size = wrappers.agg(F.sum(F.octet_length("wrapper") + F.octet_length("w_host") + 64)).first()[0] or 0
    keyed = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("w_host"))
    templates = template_texts(keyed, wrappers, size <= BROADCAST_BYTES)
    wrappers = shared_checkpoint(wrappers.join(templates, "w_host", "left"))
    size += wrappers.agg(F.sum(8 * F.size(F.coalesce("template", F.array().cast("array<long>"))))).first()[0] or 0
    joined = with_wrapper(keyed, wrappers, size <= BROADCAST_BYTES)

    def run(batches):
        wrapper = Wrappers()
        for batch in batches:
            texts = []
            for host, w, template, page in zip(*(batch.column(c) for c in ("w_host", "wrapper", "template", "html"))):
                marked, left_out = wrapper(host.as_py(), lambda: (json.loads(w.as_py()), frozenset(template.as_py() or ())))
                texts.append(extract(marked, page.as_py(), left_out))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return joined.select("page_id", "url", "html", "w_host", "wrapper", "template").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`extract_text` over all pages."""
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
