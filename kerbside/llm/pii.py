"""Personal data: fixed patterns as seeds, and contextual extraction bootstrapped from them.

1. One pass over the texts finds the base spans (e-mail, IP address, card and phone number) and what else
   looks like an identifier: tokens with a digit or an @, groups of digits over blanks, brackets, dots
   and hyphens as one, and addresses with at and dot spelled out. Each comes with the lexical patterns
   around it: the two words before it, and the word before with the word behind, in lower case and with
   digits as 0.
2. Patterns and instances (what stands between the words) form a graph. Spark scores it for `ROUNDS`
   rounds: a pattern of a kind is trusted by the share of its instances that are of that kind, each
   weighted by its own confidence; an unknown instance is believed as far as any of its patterns is
   (noisy or). Seeds keep the confidence 1.
3. Unknown identifiers that stand in a pattern with a confidence of `TRUSTED` and `SUPPORT` different
   seeds are spans of the pattern's kind.

Results: a null text is an empty text without spans. Positions are code points, ends exclusive. Added
spans never overlap base spans, which always stay. Rows that repeat get the same spans each.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import cut, id_text, near, slices

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
TRUSTED = 0.6
SUPPORT = 3
#: Patterns keep this much of a word; an instance beyond this length is known by its hash.
WORD = 40
LONGEST = 200
#: Documents with added spans up to which these are sent to all executors.
BROADCAST_ROWS = 200_000

# The domain part alone: an address starts where the run of its allowed characters before @ does.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match cannot start inside a run of digits: it would have started with the run.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]|@")
_BORDER = re.compile(r"[\s\"'<>(),;=|]")
_GROUP = re.compile(r"[-+/]?[0-9]+(?:[-./–][0-9]+)*[-/]?")
_LABEL = re.compile(r"[^\W\d_]+:+")
_BLANK = r"[^\S\r\n\v\f\x1c-\x1e\x85\u2028\u2029]"
#: What may stand between two groups of digits. A dot with a blank ends a sentence.
_JOINT = re.compile(rf"{_BLANK}{{0,2}}[()/–-]{{0,2}}{_BLANK}{{0,2}}\(?")
_DOT = rf"(?:{_BLANK}{{0,3}}[(\[{{<]{_BLANK}?(?:dot|punkt|point|punto|\.){_BLANK}?[)\]}}>]{_BLANK}{{0,3}}|{_BLANK}{{1,3}}(?:dot|punkt|point|punto|\.){_BLANK}{{1,3}}|\.)"
# All alternatives begin with a set of characters, which the search runs through quickly.
_WORD_AT = r"(?:[tT]|[rR][oO][bB][aA][sS][eE]|[rR][rR][oO][bB][aA])"
_AT = re.compile(rf"(?P<sure>[(\[{{<]{_BLANK}?(?:[aAäÄ]{_WORD_AT}|@){_BLANK}?[)\]}}>])|(?P<word>[aAäÄ](?<!\w.){_WORD_AT}(?!\w))|@")
_BLANKS = frozenset(c for c in map(chr, range(0x3001)) if re.match(_BLANK, c))
_HOST = re.compile(rf"[^\W_](?:[\w-]*\w)?(?:{_DOT}[^\W_](?:[\w-]*\w)?)*", re.IGNORECASE)
_DOMAIN_END = re.compile(rf"{_DOT}[^\W\d_]{{2,}}\Z", re.IGNORECASE)
_DOT_BEFORE = re.compile(rf"(?<=[\w%+-]){_DOT}\Z", re.IGNORECASE)
_SPAN = "struct<kind: string, begin: int, end: int>"


def _emails(text: str) -> list[tuple[int, int]]:
    found, last = [], 0
    for match in _DOMAIN.finditer(text):
        begin = at = match.start()
        while begin > last and text[begin - 1] in _LOCAL:
            begin -= 1
        if begin < at:
            last = match.end()
            found.append((begin, last))
    return found


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in (2 * int(c) for c in digits[-2::-2]))
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, begin, end) by begin, then kind as listed."""
    found = [("email", b, e) for b, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = _digits(m[0])
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_digits(m[0])) <= 15:
                    found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _touched(taken: list[tuple[int, int]], begin: int, end: int) -> bool:
    """Whether any of the spans, which are in order, overlaps the range."""
    k = bisect_left(taken, (begin, 0))
    return any(b < end and begin < e for b, e in taken[max(0, k - 8) : k + 1])


def _tokens(text: str) -> Iterator[tuple[int, int]]:
    """Tokens with a digit or an @, without the marks that end a sentence."""
    last = 0
    for match in _DIGIT.finditer(text):
        at = match.start()
        if at < last:
            continue
        begin = at
        while begin > last and not _BORDER.match(text[begin - 1]):
            begin -= 1
        border = _BORDER.search(text, at)
        last = border.start() if border else len(text)
        end = last
        while end > at + 1 and text[end - 1] in ".:!?":
            end -= 1
        yield begin, end


def _spelled(text: str) -> Iterator[tuple[int, int]]:
    """Addresses with a spelled-out at. Without brackets around it, the host must end like a domain."""
    last = 0
    for match in _AT.finditer(text):
        middle, begin = match.span()[::-1]
        while begin > last and match.start() - begin < 3 and text[begin - 1] in _BLANKS:
            begin -= 1
        while middle < len(text) and middle - match.end() < 3 and text[middle] in _BLANKS:
            middle += 1
        before, behind = begin < match.start(), middle > match.end()
        if match["word"] and not (before and behind) or not match["sure"] and not (before or behind):
            continue
        host = _HOST.match(text, middle)
        if not host:
            continue
        end, start = host.end(), begin
        if not match["sure"] and not _DOMAIN_END.search(text, max(middle, end - 2 * WORD), end):
            continue
        while begin > last:
            while begin > last and (text[begin - 1].isalnum() or text[begin - 1] in "._%+-"):
                begin -= 1
            dot = _DOT_BEFORE.search(text, max(last, begin - 20), begin) if begin < start else None
            if not dot:
                break
            begin = dot.start()
        if begin < start:
            last = end
            yield begin, end


def _candidates(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int, int, int]]:
    """What may be an identifier, of four characters or more, and touches no span: spelled-out addresses,
    groups of digits that stand together as one, and other tokens with a digit or an @. Behind each is the
    range of the whole that it is a part of: of joined groups, each of four characters or more comes too."""
    taken = sorted((b, e) for _, b, e in spans)
    found = [(b, e, b, e) for b, e in _spelled(text) if not _touched(taken, b, e)]
    taken = sorted(taken + [f[:2] for f in found])
    groups: list[tuple[int, int]] = []

    def close() -> None:
        if groups:
            whole = _bracketed(text, groups[0][0], groups[-1][1])
            found.append(whole + whole)
            if len(groups) > 1:
                found.extend((b, e, *whole) for b, e in groups)
            groups.clear()

    for begin, end in _tokens(text):
        if _touched(taken, begin, end):
            continue
        group = _GROUP.fullmatch(text, begin, end)
        if groups and not (group and begin - groups[-1][1] <= 7 and _JOINT.fullmatch(text, groups[-1][1], begin)):
            close()
        label = None if group else _LABEL.match(text, begin, end)
        if group or label and _GROUP.fullmatch(text, label.end(), end):
            groups.append((begin, end))
        else:
            found.append((begin, end, begin, end))
    close()
    return sorted(f for f in found if f[1] - f[0] >= 4)


def _bracketed(text: str, begin: int, end: int) -> tuple[int, int]:
    """With the bracket that opens before the first group, and the one that closes behind the last."""
    inner = text[begin:end]
    opened, closed = inner.find("("), inner.find(")")
    if closed >= 0 and (opened < 0 or closed < opened) and text[begin - 1 : begin] == "(":
        begin -= 1
    if inner.rfind("(") > inner.rfind(")") and text[end : end + 1] == ")":
        end += 1
    return begin, end


def _instance(found: str) -> str:
    return found if len(found) <= LONGEST else f"{found[:WORD]} {hashlib.blake2b(found.encode('utf-8', 'surrogatepass'), digest_size=16).hexdigest()}"


def _plain(word: str) -> str:
    return re.sub(r"[0-9]", "0", word.lower())[:WORD]


def _patterns(text: str, begin: int, end: int) -> list[str]:
    before = ["^", "^", *text[max(0, begin - 4 * WORD) : begin].split()][-2:]
    behind = [*text[end : end + 2 * WORD].split(), "$"][0]
    first, second, after = map(_plain, (*before, behind))
    return [f"{first} {second} _", f"{second} _ {after}"]


def _part_patterns(text: str, begin: int, end: int, first: int, last: int) -> list[str]:
    """Patterns of a part without those of its whole, which stands in them itself."""
    patterns = _patterns(text, begin, end)
    if (begin, end) == (first, last):
        return patterns
    whole = _patterns(text, first, last)
    return [p for p in patterns if p not in whole]


def marks(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, t, n_chars, base, seen) of every row: base spans, and all instances with their patterns.
    `t` is a hash of the text; it tells rows of one doc_id apart."""
    span = pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32())])
    seen = pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32()), ("whole", pa.int32()), ("is_whole", pa.bool_()), ("instance", pa.string()), ("patterns", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            base, around, sizes = [], [], []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text)
                places = [*((k, b, e, b, e) for k, b, e in spans), *((None, *c) for c in _candidates(text, spans))]
                sizes.append(len(text))
                base.append([{"kind": k, "begin": b, "end": e} for k, b, e in spans])
                around.append([
                    {"kind": k, "begin": b, "end": e, "whole": first, "is_whole": (b, e) == (first, last), "instance": _instance(text[b:e]), "patterns": _part_patterns(text, b, e, first, last)}
                    for k, b, e, first, last in places
                ])
            columns = [batch.column("doc_id"), batch.column("t"), pa.array(sizes, pa.int64()), pa.array(base, pa.list_(span)), pa.array(around, pa.list_(seen))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "t", "n_chars", "base", "seen"])

    rows = id_text(documents, id_col, text_col).withColumn("t", F.xxhash64("text"))
    schema = f"doc_id long, t long, n_chars long, base array<{_SPAN}>, seen array<struct<kind: string, begin: int, end: int, whole: int, is_whole: boolean, instance: string, patterns: array<string>>>"
    return cut(rows.mapInArrow(run, schema))


def _scored(edges: DataFrame, rounds: int) -> DataFrame:
    """(pattern, kind, trust, support) after the last round."""
    sizes = cut(edges.groupBy("pattern").agg(F.count_distinct("instance").alias("size")))
    seeds = edges.filter("kind IS NOT NULL").select("instance", "kind").distinct().withColumn("belief", F.lit(1.0))
    unknown = edges.filter("kind IS NULL").select("pattern", "instance").distinct()
    pairs = cut(edges.select("pattern", "instance").distinct())
    beliefs, patterns = cut(seeds), None
    for k in range(rounds):
        hits = pairs.join(beliefs, "instance").groupBy("pattern", "kind").agg(
            F.sum("belief").alias("hits"), F.sum((F.col("belief") == 1.0).cast("long")).alias("support")
        )
        trust = (F.col("hits") / (F.col("size") + 1)).alias("trust")
        patterns = cut(cut(hits).join(sizes, "pattern").select("pattern", "kind", trust, "support").filter(f"support >= {SUPPORT}"))
        if k + 1 < rounds:
            believed = unknown.join(patterns, "pattern").groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.least("trust", F.lit(0.999)))))).alias("belief"))
            beliefs = cut(seeds.unionByName(believed.join(seeds.select("instance", "kind"), ["instance", "kind"], "left_anti")))
    return patterns


def _row_key() -> list[Column]:
    return [F.coalesce("doc_id", F.lit(-(1 << 63))).alias("row"), F.col("t")]


def discovered(marked: DataFrame, rounds: int = ROUNDS, trusted: float = TRUSTED) -> DataFrame:
    """(row, t, added array<span>): identifiers in trusted patterns, by row."""
    seen = marked.select(*_row_key(), F.explode("seen").alias("s")).select("row", "t", "s.*")
    edges = cut(seen.select("kind", "instance", F.explode("patterns").alias("pattern")).distinct())
    patterns = _scored(edges, rounds).filter(F.col("trust") >= trusted)
    places = seen.filter("kind IS NULL").select("row", "t", "begin", "end", "whole", "is_whole", F.explode("patterns").alias("pattern"))
    best = places.join(cut(patterns.select("pattern", "kind", "trust")), "pattern").groupBy("row", "t", "whole", "is_whole", "begin", "end").agg(
        F.max_by("kind", F.struct("trust", "kind")).alias("kind")
    )
    # Rows that repeat have the same spans, so each comes once; parts give way to their whole.
    wholes = best.groupBy("row", "t", "whole").agg(F.max("is_whole").alias("is_whole"), F.collect_list(F.struct("is_whole", "kind", "begin", "end")).alias("parts"))
    spans = F.transform(F.filter("parts", lambda p: p["is_whole"] == F.col("is_whole")), lambda p: F.struct(p["kind"].alias("kind"), p["begin"].alias("begin"), p["end"].alias("end")))
    return cut(wholes.groupBy("row", "t").agg(F.flatten(F.collect_list(spans)).alias("added")))


def find(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, base, spans) of every row: the base spans, and all with the added ones."""
    marked = marks(documents, id_col, text_col)
    keyed = marked.select("doc_id", *_row_key(), "n_chars", "base").join(discovered(marked), ["row", "t"], "left")
    every = F.concat("base", F.coalesce("added", F.array().cast(f"array<{_SPAN}>")))
    return keyed.select("doc_id", "n_chars", "base", in_order(every).alias("spans"))


def in_order(spans: Column) -> Column:
    """Spans by begin, then kind as listed."""
    rank = F.array(*map(F.lit, KINDS))
    keyed = F.transform(spans, lambda s: F.struct(s["begin"].alias("begin"), F.array_position(rank, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["begin"].alias("begin"), s["end"].alias("end")))


def written(spans: Column) -> Column:
    """kind:begin:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    out, last = [], 0
    for kind, begin, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if begin >= last:
            out += [text[last:begin], f"[{kind.upper()}]"]
        last = max(last, end)
    return "".join([*out, text[last:]])


def masked(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with every span replaced by its kind in brackets; overlapping spans by that of the first.
    Rows without spans, and null texts, stay as they are."""
    marked = marks(documents, id_col, text_col)
    names = documents.columns
    spare = f"{'_'.join(names)}_added"  # no column of the input has this name
    added = discovered(marked).withColumnRenamed("row", f"{spare}_row").withColumnRenamed("t", f"{spare}_t").withColumnRenamed("added", spare)
    keyed = documents.withColumn(f"{spare}_row", F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))).withColumn(f"{spare}_t", F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    joined = keyed.join(near(added, BROADCAST_ROWS), [f"{spare}_row", f"{spare}_t"], "left").select(*names, spare)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index(text_col)
            texts = []
            for text, more in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist(), strict=True):
                spans = base_spans(text or "") + [(s["kind"], s["begin"], s["end"]) for s in more or []]
                texts.append(_masked(text, spans) if spans else text)
            columns = [*batch.columns[:at], pa.array(texts, pa.string()), *batch.columns[at + 1 : len(names)]]
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(run, documents.schema)
