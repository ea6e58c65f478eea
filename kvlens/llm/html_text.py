"""Main text of web pages by a suffix array over each host's token streams.

Pages are taken where they lie, in shards of at most ``SHARD`` pages and
``SHARD_BYTES`` of text. A shard's words form one stream; sorting its suffixes by
prefix doubling, to ``LONG`` words deep, puts equal runs of a host side by side. A
run that stands on two distinct pages of its host is repeated, and every longer
repeat is a chain of such runs, so their union covers just the words in repeats of
``LONG`` words or more.

Shards then compare notes, without moving a page. Equal runs hold the same least
hash of their shorter runs (a minimizer), so a shard sends the set of its
minimizers, packed, to the host's parts, and gets back those that another shard
has too. Only runs with such a minimizer can stand in two shards: they are added
up over the host by a 64-bit hash, and the sums go back. The result is that of one
array over the whole host, whatever the shards.

Covered words are boilerplate and uncovered runs are kept, with one check after
it: marked-up structure has the last word where there is any. Inside an article
(or main element) a block goes if all its words are in repeated runs that stand in
half of the host's rows (``MANY`` at least) and the article has other blocks; what
repeats less stays, as syndicated articles and quoted passages repeat too; menus,
headers, footers, sidebars, notices, adverts, forms and comments go even where they
stand on one page only. The array alone decides on unmarked blocks outside of
articles, whether or not the page has an article.

Defined cases: null html has an empty text; null urls, and urls without a host, are
pages of one host; repeated rows each get a row and don't count as distinct pages
if their page_id is the same; rows with a null page_id are the same page if url and
html are; an empty table gives no rows; other columns than the three are left out.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import pieces
from .storage import fresh, get, put, written

SHARD, SHARD_BYTES, LONG = 4096, 1 << 23, 8
#: Pages of a host whose minimizers meet in one task, and the share of all pages (1 in HOSTS) from which on a host may have several.
PART, HOSTS = 16384, 10_000
#: A block of an article is boilerplate if its words are on half of the host's rows, and on so many at least.
MANY = 3

# Names of HTML elements, and words of class, id and role by which sites mark what isn't text.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object", "canvas", "video", "audio", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search", "section", "select", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul"}
DROPPED = {"nav", "footer", "aside", "form", "head", "menu", "dialog", "button", "select", "fieldset", "search", "datalist"}
DROP_WORDS = {"ad", "ads", "adbox", "adsense", "adslot", "advert", "adverts", "advertisement", "advertising", "adv", "sponsor", "sponsored", "promo", "promotion", "promoted", "banner", "sidebar", "sidebars", "rail", "widget", "widgets", "nav", "navbar", "navigation", "menu", "menus", "breadcrumb", "breadcrumbs", "footer", "colophon", "masthead", "topbar", "toolbar", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert", "disclaimer", "popup", "modal", "overlay", "paywall", "newsletter", "subscribe", "subscription", "signup", "login", "comment", "comments", "commentlist", "reply", "replies", "disqus", "discussion", "respond", "share", "sharing", "social", "related", "recommended", "recommendations", "pagination", "pager", "skip", "search", "copyright", "legal", "contentinfo", "complementary"}
HEAD_WORDS = {"header", "head", "heading", "top"}
MAIN_WORDS = {"article", "main", "content", "story", "entry", "post", "articlebody"}
#: Words that name a subject as well: inside an article a class of these alone marks nothing.
SUBJECTS = {"legal", "search", "notice", "notices", "alert", "discussion", "consent", "promotion", "rail"}
#: Words that stand beside those words in the name of a page's part.
PARTS = {"area", "bar", "block", "body", "bottom", "box", "button", "buttons", "col", "column", "container", "content", "div", "fixed", "form", "global", "group", "holder", "icons", "inner", "item", "items", "left", "level", "line", "link", "links", "list", "main", "outer", "page", "panel", "primary", "right", "secondary", "section", "side", "site", "slot", "sticky", "thread", "top", "unit", "wrap", "wrapper", "zone"}
BEFORE = {"with", "has", "no", "without", "js", "is"}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<(/?)([A-Za-z][A-Za-z0-9:_-]*+)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([A-Za-z][A-Za-z0-9:_-]*+)([^>]*+)>|<[!?/][^>]*+>""", re.S)
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"

PLAIN, MAIN, DROP = 0, 1, 2


def _marks(names: list[list[str]], marking: set[str]) -> bool:
    """Whether a class or id as a whole names a part of a page by one of these words: not a word within another name."""
    return any(not marking.isdisjoint(parts) and all(p in marking or p in PARTS or len(p) == 1 for p in parts) for parts in names)


def _kind(tag: str, attributes: str, outer: int, inside: bool) -> tuple[int, bool]:
    """What an element's blocks are, and whether it is an article or main element itself."""
    names, role, main_part = [], "", False
    if attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(values)
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
                return DROP, False
            if name == "role":
                role = value.lower()
            elif name == "itemprop":
                main_part |= value == "articleBody"
            elif name in ("class", "id"):
                for one in value.split():
                    parts = [w.lower() for w in _WORDS.findall(one)]
                    if not any(p in BEFORE for p in parts):
                        names.append(parts)
    if outer == DROP or tag in DROPPED:
        return DROP, False
    if tag in ("body", "html"):
        return outer, False
    if tag == "main" or role == "main":
        return MAIN, True
    if tag == "article" or main_part:
        return MAIN, True
    if role in DROP_WORDS or _marks(names, DROP_WORDS - SUBJECTS if inside else DROP_WORDS):
        return DROP, False
    in_main = any(not MAIN_WORDS.isdisjoint(parts) for parts in names)
    if not inside and (tag == "header" or (role in HEAD_WORDS or _marks(names, HEAD_WORDS)) and not in_main):
        return DROP, False
    return outer, False


def blocks(page: str) -> list[tuple[str, int, bool]]:
    """(text, kind, in an article) of a page's blocks, in page order."""
    out: list[tuple[str, int, bool]] = []
    text: list[str] = []
    stack: list[tuple[str, int, bool]] = []  # tag, kind, in an article
    state, inside = PLAIN, False

    def end_block() -> None:
        if text:
            words = " ".join(_html.unescape("".join(text)).split())
            text.clear()
            if words:
                out.append((words, state, inside))

    def settle() -> None:
        nonlocal state, inside
        state, inside = (stack[-1][1], stack[-1][2]) if stack else (PLAIN, False)

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            text.append(page[at:])
            break
        if m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            if m[0].startswith("<![CDATA["):
                text.append(_html.escape(m[0][9:-3], False))
            continue
        tag, closing, attributes = tag.lower(), m[1] or m[4], m[3] if m[2] else m[6]
        if closing:
            if tag in BLOCK:
                end_block()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    settle()
                    break
            continue
        if tag in RAW:
            if not attributes.rstrip().endswith("/") or tag not in ("svg", "math"):
                close = re.compile(rf"</{tag}(?=[\s>/])[^>]*>", re.I).search(page, at)
                at = close.end() if close else size
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in ("td", "th"):
            text.append(" ")
        if tag in BLOCK:
            end_block()
            # An open paragraph ends where a block starts; an item ends where the next one starts.
            while stack and (stack[-1][0] == "p" or tag in ("li", "dt", "dd", "option") and stack[-1][0] == tag):
                stack.pop()
            settle()
        if tag in VOID or attributes.endswith("/") and tag not in BLOCK:
            continue
        kind, starts = _kind(tag, attributes, state, inside)
        if tag in BLOCK or kind != state:
            if tag not in BLOCK:
                # An inline element that is dropped: its text is apart from its block's.
                before, now = list(text), state
                text.clear()
                stack.append((tag, kind, inside))
                at = _skip(page, at, tag) if kind == DROP else at
                if kind == DROP:
                    stack.pop()
                text.extend(before)
                state = now if kind == DROP else kind
                continue
            stack.append((tag, kind, inside or starts))
            state, inside = kind, inside or starts
    end_block()
    return out


def _skip(page: str, at: int, tag: str) -> int:
    """The end of an inline element."""
    depth = 1
    for m in re.compile(rf"<(/?){re.escape(tag)}(?=[\s>/])[^>]*>", re.I).finditer(page, at):
        depth += -1 if m[1] else 1
        if not depth:
            return m.end()
    return len(page)


PRIME, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: Bits of a minimizer that shards exchange: more than these only chance makes equal, and that is looked into.
BITS = 40


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    return x ^ (x >> np.uint64(29))


def _hashes(strings: list[str]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass"), 42) for s in strings), np.uint64, len(strings))


class Shard:
    """Pages of any hosts (columns page_id, url, key, host, text, kind, inside) as a stream of words."""

    def __init__(self, pages: pa.Table, long: int = LONG):
        self.pages, self.long = pages.combine_chunks(), long
        text = self._column("text")
        self.block_of = text.offsets.to_numpy()  # of each page, its first block
        lists = pc.split_pattern(text.values, " ")
        words = lists.flatten().dictionary_encode()
        self.number, self.vocabulary = words.indices.to_numpy().astype(np.int64), words.dictionary
        self.word_of = lists.offsets.to_numpy()  # of each block, its first word
        self.begin = self.word_of[self.block_of]  # of each page
        self.page = np.repeat(np.arange(len(pages)), np.diff(self.begin))
        host = self._column("host").dictionary_encode()
        self.hosts, self.host = host.dictionary.to_pylist(), host.indices.to_numpy().astype(np.int64)
        self.key = self._column("key").to_numpy()
        at = np.arange(len(self.number))
        self.end = self.begin[1:][self.page]
        self.starts = np.flatnonzero(at + long <= self.end)  # of runs

    def _column(self, name: str) -> pa.Array:
        column = self.pages[name]
        return column.chunk(0) if column.num_chunks else pa.array([], column.type)

    def counted(self, runs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each start its run's number; for each run its value, how many rows it stands on, and the least and greatest key of these."""
        value, of = np.unique(runs, return_inverse=True)
        order = np.argsort(of, kind="stable")
        page = self.page[starts][order]
        first = np.flatnonzero(np.diff(of[order], prepend=-1))
        if not len(first):
            return of, value, first, first, first
        new = (np.diff(of[order], prepend=-1) != 0) | (np.diff(page, prepend=-1) != 0)
        key = self.key[page]
        return of, value, np.add.reduceat(new.astype(np.int64), first), np.minimum.reduceat(key, first), np.maximum.reduceat(key, first)

    def repeats(self) -> tuple[np.ndarray, np.ndarray]:
        """For each run's start: rows of this shard that it stands on, and whether on distinct pages; by the suffix array."""
        n, at = len(self.number), np.arange(len(self.number))
        # Prefix doubling: a suffix's rank by its first 2k words is that of the pair of ranks by k words; no suffix goes over its page's end.
        rank, depth = self.number + len(self.vocabulary) * self.host[self.page], 1
        while depth < self.long:
            step = min(depth, self.long - depth)
            there = at + step < self.end
            after = np.where(there, rank[np.where(there, at + step, 0)], -1) if n else rank
            _, rank = np.unique(rank * (int(rank.max(initial=0)) + 2) + after + 1, return_inverse=True)
            depth += step
        of, _, rows, low, high = self.counted(rank[self.starts], self.starts)
        return rows[of], (low != high)[of]

    def _grams(self, size: int, seed: int) -> np.ndarray:
        """64-bit hashes of the host and ``size`` words from each place on: a polynomial in the words' XXH64."""
        word = np.concatenate([_hashes(self.vocabulary.to_pylist())[self.number], np.zeros(size, np.uint64)])
        out = (_hashes(self.hosts) ^ np.uint64(seed))[self.host][self.page]
        for k in range(size):
            out = out * PRIME + word[k : k + len(out)]
        return _mixed(out)

    def minimizers(self) -> np.ndarray:
        """For each run's start, the least hash of its shorter runs, cut to ``BITS``."""
        size = max(1, self.long - 3)
        gram = self._grams(size, 1)
        least = gram[self.starts]
        for k in range(1, self.long - size + 1):
            least = np.minimum(least, gram[self.starts + k])
        return least >> np.uint64(64 - BITS)

    def runs(self) -> np.ndarray:
        """For each run's start, its hash."""
        return self._grams(self.long, 2)[self.starts]

    def covered(self, chosen: np.ndarray) -> np.ndarray:
        """Which words are in the chosen ones of the runs."""
        n = len(self.number)
        edge = np.bincount(self.starts[chosen], minlength=n + 1) - np.bincount(self.starts[chosen] + self.long, minlength=n + 1)
        return np.cumsum(edge)[:n] > 0

    def texts(self, rows: np.ndarray, distinct: np.ndarray, host_rows: np.ndarray) -> list[str]:
        """The pages' main texts; rows and distinct as of ``repeats`` and host_rows by host, over whole hosts."""
        many = np.maximum(MANY, -(-host_rows // 2))[self.host][self.page[self.starts]]
        boiler = self.covered(distinct)
        upto = np.concatenate([[0], np.cumsum(self.covered(distinct & (rows >= many)))])
        size = np.diff(self.word_of)
        common = upto[self.word_of[1:]] - upto[self.word_of[:-1]] == size
        upto = np.concatenate([[0], np.cumsum(boiler)])
        touched = upto[self.word_of[1:]] > upto[self.word_of[:-1]]
        text = self._column("text").values.to_pylist()
        kind, inside = (self._column(c).values.to_numpy(zero_copy_only=False) for c in ("kind", "inside"))
        within = inside & (kind != DROP)
        out = []
        for a, b in zip(self.block_of[:-1].tolist(), self.block_of[1:].tolist(), strict=True):
            # Where nothing else is in the article, the pages are copies of each other and it stays.
            copies = bool(common[a:b][within[a:b]].all())
            kept = []
            for i in range(a, b):
                if kind[i] == DROP or inside[i] and common[i] and not copies:
                    continue
                block = text[i]
                if touched[i] and not inside[i]:
                    block = " ".join(w for w, c in zip(block.split(" "), boiler[self.word_of[i] : self.word_of[i + 1]].tolist(), strict=True) if not c)
                if block:
                    kept.append(block)
            out.append("\n".join(kept))
        return out


def parsed(pages: list[str | None]) -> dict[str, pa.Array]:
    """Columns text, kind and inside: each page's blocks."""
    found = [blocks(p or "") for p in pages]
    kinds = (("text", pa.string()), ("kind", pa.int8()), ("inside", pa.bool_()))
    return {name: pa.array([[x[i] for x in b] for b in found], pa.list_(t)) for i, (name, t) in enumerate(kinds)}


def main_texts(page_ids: list, pages: list[str | None], long: int = LONG) -> list[str]:
    """The main texts of a whole host's pages, in one shard."""
    _, key = np.unique([str(p) for p in page_ids], return_inverse=True)
    shard = Shard(pa.table({"key": pa.array(key, pa.int64()), "host": pa.array([""] * len(pages)), **parsed(pages)}), long)
    return shard.texts(*shard.repeats(), np.array([len(pages)]))


def _packed(*columns: np.ndarray) -> bytes:
    """64-bit numbers, the first column ascending: byte plane by byte plane, compressed."""
    import zstandard as z

    columns = [c.astype("<u8") for c in columns]
    wide = np.stack([np.diff(columns[0], prepend=np.uint64(0)), *columns[1:]])
    return z.ZstdCompressor(level=3).compress(wide.view(np.uint8).reshape(len(columns), -1, 8).transpose(0, 2, 1).tobytes())


def _unpacked(blob: bytes, columns: int = 1) -> np.ndarray:
    import zstandard as z

    planes = np.frombuffer(z.ZstdDecompressor().decompress(blob), np.uint8).reshape(columns, 8, -1)
    wide = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u8")[..., 0]
    return np.concatenate([np.cumsum(wide[:1], axis=1, dtype=np.uint64), wide[1:]])


def _ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


#: What goes to a host's parts and back to its shards; part 0 of each host carries the host's rows, and there is a row of it for every shard.
NOTES = "host string, part long, parts long, shard long, rows long, first binary, second binary"
NOTE = pa.schema([("host", pa.string()), *[(n, pa.int64()) for n in ("part", "parts", "shard", "rows")], ("first", pa.binary()), ("second", pa.binary())])


def _notes(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(NOTE)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, NOTE, strict=True)], schema=NOTE)


def _at(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:016x}"


def _load(folder: str, shard: int, long: int) -> tuple[Shard, pa.Table]:
    """A shard, and its own counts (count, distinct) for each of its runs."""
    blob = get(_at(folder, shard))
    size = int.from_bytes(blob[:8], "little")
    return Shard(pa.ipc.open_stream(blob[8 : 8 + size]).read_all(), long), pa.ipc.open_stream(blob[8 + size :]).read_all()


def _store(folder: str, no: int, held: list[pa.RecordBatch], long: int) -> pa.RecordBatch:
    """Parses pages and writes them with the shard's own counts; notes: its minimizers by host and part."""
    table = pa.Table.from_batches(held)
    pages = table.select(["page_id", "url", "key", "host"])
    for name, column in parsed(table["html"].to_pylist()).items():
        pages = pages.append_column(name, column)
    shard = Shard(pages, long)
    rows, distinct = shard.repeats()
    first = _ipc(pages)
    put(_at(folder, no), [len(first).to_bytes(8, "little"), first, _ipc(pa.table({"count": pa.array(rows), "distinct": pa.array(distinct)}))])
    parts = np.ones(len(shard.hosts), np.int64)
    parts[shard.host] = table["parts"].to_numpy()
    least, of = shard.minimizers(), shard.host[shard.page[shard.starts]]
    order = np.lexsort((least, of))
    least, of = least[order], of[order]
    new = (np.diff(of, prepend=-1) != 0) | (np.diff(least, prepend=np.uint64(0)) != 0)
    least, of = least[new], of[new]
    n = np.bincount(shard.host, minlength=len(shard.hosts)).tolist()
    return _notes([(shard.hosts[h], part, int(parts[h]), no, n[h] if part == 0 else None, _packed(least[a:b]) if b > a else None, None) for h, part, a, b in _dealt(of, least, parts)])


def _dealt(of: np.ndarray, value: np.ndarray, parts: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(host, part, first, last) of each host's parts of values of ``BITS`` bits, in order of host and value; part 0 always."""
    part = ((value * parts.astype(np.uint64)[of]) >> np.uint64(BITS)).astype(np.int64)
    cut = np.flatnonzero((np.diff(of, prepend=-1) != 0) | (np.diff(part, prepend=-1) != 0))
    there = set()
    for a, b in zip(cut.tolist(), np.append(cut, len(of))[1:].tolist(), strict=True):
        if not part[a]:
            there.add(int(of[a]))
        yield int(of[a]), int(part[a]), a, b
    for h in sorted({*range(len(parts))} - there):
        yield h, 0, 0, 0


def _groups(batches: Iterator[pa.RecordBatch], *key: str) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by key."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = list(zip(*(batch[k].to_pylist() for k in key), strict=True))
        a = 0
        while a < len(keys):
            b = a + 1
            while b < len(keys) and keys[b] == keys[a]:
                b += 1
            if held and keys[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            last = keys[a]
            held.append(batch.slice(a, b - a))
            a = b
    if held:
        yield pa.Table.from_batches(held)


def _split(of: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each value of an ascending array, and where it is."""
    cut = np.flatnonzero(np.diff(of, prepend=-1))
    for a, b in zip(cut.tolist(), np.append(cut, len(of))[1:].tolist(), strict=True):
        yield int(of[a]), slice(a, b)


def _answers(table: pa.Table, found: dict[int, tuple[bytes, bytes | None]], rows) -> pa.RecordBatch:
    """What goes back from a part: to each shard what was found; from part 0 the host's rows too."""
    host, part, parts = (table[c][0].as_py() for c in ("host", "part", "parts"))
    return _notes([(host, part, parts, shard, rows, *found.get(i, (None, None))) for i, shard in enumerate(table["shard"].to_pylist()) if part == 0 or i in found])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each shard of a host's part, the minimizers that other shards have too."""
    for table in _groups(batches, "host", "part"):
        lists = [_unpacked(b)[0] if b else np.empty(0, np.uint64) for b in table["first"].to_pylist()]
        value, of = np.concatenate(lists), np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        order = np.argsort(value, kind="stable")
        same = np.diff(value[order]) == 0
        found = order[np.append(same, False) | np.append(False, same)] if len(order) else order
        found = found[np.argsort(of[found], kind="stable")]  # by shard, each shard's still ascending
        yield _answers(table, {i: (_packed(value[found][at]), None) for i, at in _split(of[found])}, pc.sum(table["rows"]).as_py())


def _candidates(folder: str, long: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's runs that may stand in other shards: hash and count, and the least and greatest key of their pages."""
    for table in _groups(batches, "shard"):
        no = table["shard"][0].as_py()
        own, _ = _load(folder, no, long)
        shared = np.unique(np.concatenate([np.empty(0, np.uint64), *(_unpacked(b)[0] for b in table["first"].to_pylist() if b)]))
        least = own.minimizers()
        chosen = shared[np.minimum(np.searchsorted(shared, least), len(shared) - 1)] == least if len(shared) else np.zeros(len(least), bool)
        # A run's hash is cut by host and value as the minimizers were.
        starts, runs = own.starts[chosen], own.runs()[chosen]
        of, run, count, low, high = own.counted(runs, starts)
        host = np.empty(len(run), np.int64)
        host[of] = own.host[own.page[starts]]
        order = np.lexsort((run, host))
        run, count, low, high, host = run[order], count[order], low[order], high[order], host[order]
        parts, rows = np.ones(len(own.hosts), np.int64), [None] * len(own.hosts)
        number = {h: i for i, h in enumerate(own.hosts)}
        for h, n, r in zip(table["host"].to_pylist(), table["parts"].to_pylist(), table["rows"].to_pylist(), strict=True):
            parts[number[h]], rows[number[h]] = n, r if r is not None else rows[number[h]]
        out = []
        for h, part, a, b in _dealt(host, run >> np.uint64(64 - BITS), parts):
            first = second = None
            if b > a:
                keys = np.unique(np.concatenate([low[a:b], high[a:b]]))
                lows, highs = np.searchsorted(keys, low[a:b]), np.searchsorted(keys, high[a:b])
                first, second = _packed(run[a:b], count[a:b], lows, highs - lows), _packed(keys)
            out.append((own.hosts[h], part, int(parts[h]), no, rows[h] if part == 0 else None, first, second))
        yield _notes(out)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each shard of a host's part, its runs that stand in other shards too, their counts over all, and whether on distinct pages."""
    for table in _groups(batches, "host", "part"):
        lists, keys = [], []
        for a, b in zip(table["first"].to_pylist(), table["second"].to_pylist(), strict=True):
            one = _unpacked(a, 4) if a else np.empty((4, 0), np.uint64)
            key = _unpacked(b)[0].view(np.int64) if b else np.empty(0, np.int64)
            lists.append(one)
            keys.append((key[one[2]], key[one[2] + one[3]]))
        run, count = (np.concatenate([x[i] for x in lists]) for i in (0, 1))
        low, high = (np.concatenate([x[i] for x in keys]) for i in (0, 1))
        of = np.repeat(np.arange(len(lists)), [x.shape[1] for x in lists])
        found: dict = {}
        if len(run):
            order = np.argsort(run, kind="stable")
            first = np.flatnonzero(np.append(True, np.diff(run[order]) != 0))
            size = np.diff(np.append(first, len(run)))
            total = np.repeat(np.add.reduceat(count[order], first), size)
            distinct = np.repeat(np.minimum.reduceat(low[order], first) != np.maximum.reduceat(high[order], first), size)
            many = np.repeat(size > 1, size)
            order, total, distinct = order[many], total[many], distinct[many]
            back = np.argsort(of[order], kind="stable")
            order, total, distinct = order[back], total[back], distinct[back].astype(np.uint64)
            found = {i: (_packed(run[order][at], total[at], distinct[at]), None) for i, at in _split(of[order])}
        yield _answers(table, found, pc.sum(table["rows"]).as_py() if table["part"][0].as_py() else table["rows"][0].as_py())


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", shard: int = SHARD, long: int = LONG) -> DataFrame:
    """One row per row: page_id, url, text, n_chars."""
    spark = pages.sparkSession
    folder = fresh(spark, "html-pages")
    rows = pages.select(pages[page_id].alias("page_id"), pages[url].cast("string").alias("url"), pages[html].cast("string").alias("html"))
    rows = rows.withColumn("host", F.coalesce(F.lower(F.regexp_extract("url", _SCHEME, 1)), F.lit(""))).withColumn("key", F.when(F.col("page_id").isNull(), F.xxhash64("url", "html")).otherwise(F.xxhash64("page_id")))
    total = pages.count()
    # At most HOSTS hosts hold more than one in HOSTS of the pages: what is broadcast has that bound.
    large = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max(PART, total // HOSTS)).select(F.col("host").alias("large"), F.ceil(F.col("n") / PART).cast("long").alias("parts"))
    dealt = rows.join(F.broadcast(written(large, "html-large")), F.col("host") == F.col("large"), "left").select("page_id", "url", "html", "host", "key", F.coalesce("parts", F.lit(1).cast("long")).alias("parts"), F.spark_partition_id().alias("partition"))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, size, no = [], 0, 0, 0
        for batch in pieces(batches, "html"):
            for a in range(0, len(batch), shard):
                part = batch.slice(a, shard)
                if held and (n + len(part) > shard or size >= SHARD_BYTES):
                    yield _store(folder, number + no, held, long)
                    held, n, size, no = [], 0, 0, no + 1
                if not held:
                    number = part["partition"][0].as_py() << 32
                held.append(part)
                n += len(part)
                size += pc.sum(pc.binary_length(part["html"])).as_py() or 0
        if held:
            yield _store(folder, number + no, held, long)

    to_parts = lambda df: df.repartition("host", "part").sortWithinPartitions("host", "part")
    to_shards = lambda df: df.repartition("shard").sortWithinPartitions("shard")
    shared = to_parts(dealt.mapInArrow(first, NOTES)).mapInArrow(_shared, NOTES)
    runs = to_shards(shared).mapInArrow(lambda batches: _candidates(folder, long, batches), NOTES)
    back = to_shards(to_parts(runs).mapInArrow(_added, NOTES))
    schema = T.StructType([rows.schema["page_id"], T.StructField("url", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "shard"):
            own, counted = _load(folder, table["shard"][0].as_py(), long)
            run, total, distinct_ = np.concatenate([np.empty((3, 0), np.uint64), *(_unpacked(b, 3) for b in table["first"].to_pylist() if b)], axis=1)
            order = np.argsort(run)
            run, total, distinct_ = run[order], total[order], distinct_[order]
            rows, distinct = counted["count"].to_numpy().copy(), counted["distinct"].to_numpy().copy()
            if len(run):
                mine = own.runs()
                at = np.minimum(np.searchsorted(run, mine), len(run) - 1)
                known = run[at] == mine
                rows[known], distinct[known] = total[at[known]], distinct_[at[known]]
            of = {h: n for h, n in zip(table["host"].to_pylist(), table["rows"].to_pylist(), strict=True) if n is not None}
            text = own.texts(rows, distinct, np.array([of[h] for h in own.hosts], np.int64))
            for a in range(0, len(text), 512):
                b = pa.array(text[a : a + 512], pa.string())
                yield pa.RecordBatch.from_arrays([*(own._column(c).slice(a, 512) for c in ("page_id", "url")), b, pc.utf8_length(b).cast(pa.int64())], names=schema.names)

    return back.mapInArrow(last, schema)


def op10(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
