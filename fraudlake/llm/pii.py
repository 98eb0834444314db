"""Personal data by patterns, and terms that give it away by co-occurrence.

Base spans come from fixed patterns (email, ip, card, phone). Information-
theoretic sanitisation then looks for further terms: a protected entity ``e``
is a base value; with document counts over the whole corpus,

    IC(e)     = log2(N / n_e)
    PMI(t, e) = log2(n_te * N / (n_t * n_e))

where ``n_t``, ``n_e`` and ``n_te`` count distinct whole texts with ``t``, with ``e``
and with both, among ``N`` distinct texts: copies of a text are one witness, not
several. A document has ``t`` if it stands there as a word (letters in
lower case) outside base spans. ``PMI / IC`` is the share of what is known about
``e`` that ``t`` discloses (1: ``t`` tells it all). Terms that disclose
``remove_at`` or more of any entity are removed and those from ``generalise_at``
on replaced by their class wherever they stand, in every document, with or
without a base span. Terms and entities seen together in fewer than ``support``
distinct texts are left alone: such counts are no evidence.

Scale: one scan finds base spans and stages them, with the distinct words of
documents that have an entity; another counts frequencies over distinct texts, summed
per batch before the shuffle. A bitmap of the hashes of repeated texts, of ``_BITS``
bits at most, tells which texts are surely alone: these are counted where they
are read, and only the others are shuffled, to meet their copies (those that share
a bit with one by chance meet nobody, and count once all the same). The tables of
pairs have one row per (entity, term) of
entities in ``support`` documents; skewed joins are split. A third scan places
the disclosing terms: a like bitmap of their hashes drops
nearly all other words before the join, which is exact.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import staged

KINDS = ("email", "ip", "card", "phone")
ADDED = ("remove", "generalise")
_LOCAL_END = re.compile(r"[^A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"\w+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_BITS = 1 << 27  # most bits of a bitmap of hashes (16 MB)
_BLOCK = 1 << 15  # bits of one value of bitmap_construct_agg


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the local part is the whole run of its characters before
    an ``@`` that a match can still take."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        # The next local part ends at the next @ and cannot pass this one.
        done = max(done, at + 1)
        at = text.find("@", done)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _ip_part_ok(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every base span, in order."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(map(_ip_part_ok, m[0].split("."))):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    at = text.find("+")
    while at >= 0:
        m = _PHONE.match(text, at)
        if m and 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
        at = text.find("+", m.end() if m else at + 1)
    return sorted(out)


def free_words(text: str, spans: list) -> Iterator[re.Match]:
    """Words of the text between its base spans, in order."""
    at = 0
    for a, _, b in spans:
        yield from _WORD.finditer(text, at, max(at, a))
        at = max(at, b)
    yield from _WORD.finditer(text, at)


def terms_of(text: str, spans: list) -> set[str]:
    """Distinct free words; lower() can change what a word is, so it comes last."""
    return {w.lower() for w in {m[0] for m in free_words(text, spans)}}


_FOUND = ("doc_id long, text_key long, n_email long, n_ip long, n_card long, n_phone long, "
          "base string, entities array<string>, words array<string>")


def _find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_id, key, text in zip(batch["doc_id"], batch["text_key"], batch["text"],
                                     strict=True):
            spans = base_spans(text) if text else []
            entities = {f"{KINDS[kind]}:{text[a:b].lower()}" for a, kind, b in spans}
            count = Counter(k for _, k, _ in spans)
            rows.append((doc_id, key, *[count[k] for k in range(4)],
                         ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans),
                         sorted(entities), sorted(terms_of(text, spans)) if spans else []))
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in _FOUND.split(", ")])
        out["doc_id"] = out["doc_id"].astype("Int64")
        yield out


def _frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(term, n): documents of the batch that have the term."""
    for batch in batches:
        counts: Counter = Counter()
        for text in batch["text"]:
            if text:
                counts.update(terms_of(text, base_spans(text)))
        if counts:
            yield pd.DataFrame({"term": list(counts), "n": list(counts.values())})


def disclosure(docs: DataFrame, found: DataFrame, support: int) -> DataFrame:
    """(entity, term, share): PMI / IC of every pair seen in ``support`` distinct texts.
    ``docs`` has text and text_key."""
    keys = found.groupBy("text_key").agg(F.count("*").alias("n"))
    total, repeated = keys.agg(F.count("*"), F.count_if(F.col("n") > 1)).first()
    once = staged(found.filter(F.size("entities") > 0).select("text_key", "entities", "words")
                  .dropDuplicates(["text_key"]), "pii-once")
    n_e = (once.select(F.explode("entities").alias("entity")).groupBy("entity")
           .agg(F.count("*").alias("n_e")).filter(F.col("n_e") >= support))
    # Entities of fewer texts cannot be in a pair: they go before words are paired.
    live = (once.select("text_key", F.explode("entities").alias("entity"))
            .join(n_e.select("entity"), "entity").groupBy("text_key")
            .agg(F.collect_list("entity").alias("live")))
    n_te = (once.select("text_key", "words").join(live, "text_key")
            .select("words", F.explode("live").alias("entity"))
            .select("entity", F.explode("words").alias("term")).groupBy("entity", "term")
            .agg(F.count("*").alias("n_te")).filter(F.col("n_te") >= support))
    n_te = staged(n_te, "pii-pairs")
    once_each = distinct_texts(docs, keys.filter(F.col("n") > 1), repeated)
    n_t = (once_each.mapInPandas(_frequencies, "term string, n long").groupBy("term")
           .agg(F.sum("n").alias("n_t")))
    ic = F.log2(F.lit(float(max(total, 1))) / F.col("n_e"))
    pmi = F.log2(F.col("n_te") * F.lit(float(max(total, 1))) / (F.col("n_t") * F.col("n_e")))
    return (n_te.join(n_t, "term").join(n_e, "entity")
            .select("entity", "term", F.when(ic > 0, pmi / ic).otherwise(0.0).alias("share")))


def bitmap_blocks(hashes: DataFrame, number: int) -> tuple[DataFrame, int]:
    """((block, b), bits): bitmaps of ``_BLOCK`` bits each that together have the bit
    h % ``bits`` set for every row of ``hashes`` (column h); 64 bits or more for each
    of the ``number`` rows, up to ``_BITS`` in all (so 4,096 rows, 16 MB at most)."""
    bits = _BLOCK
    while bits < min(64 * number, _BITS):
        bits *= 2
    h = F.pmod("h", F.lit(bits))
    # Rows of a block meet before they become a bitmap, so no task ships more than its own.
    return (hashes.select((h / _BLOCK).cast("long").alias("block"), (h % _BLOCK).alias("bit"))
            .repartition("block").groupBy("block").agg(F.bitmap_construct_agg("bit").alias("b")),
            bits)


def bitmap(hashes: DataFrame, number: int) -> tuple[np.ndarray, int]:
    """(bytes, bits) of :func:`bitmap_blocks`."""
    blocks, bits = bitmap_blocks(hashes, number)
    out = np.zeros(bits // 8, np.uint8)
    for r in blocks.collect() if number else ():
        out[r["block"] * _BLOCK // 8:][:_BLOCK // 8] = np.frombuffer(r["b"], np.uint8)
    return out, bits


def distinct_texts(docs: DataFrame, repeated: DataFrame, number: int) -> DataFrame:
    """Every distinct text of ``docs`` (text, text_key) once. ``repeated`` has the
    ``number`` keys of texts with copies. The bitmap is looked up by a broadcast join
    (its size is bounded), so that no task runs a Python worker for it."""
    blocks, bits = bitmap_blocks(repeated.select(F.col("text_key").alias("h")), number)
    h = F.pmod("text_key", F.lit(bits))
    byte = f"conv(hex(substring(b, cast(pmod(text_key, {_BLOCK}) div 8 as int) + 1, 1)), 16, 10)"
    bit = F.expr(f"shiftright(cast({byte} as int), cast(pmod(text_key, 8) as int)) & 1")
    marked = (docs.select("text", "text_key", (h / _BLOCK).cast("long").alias("block"))
              .join(F.broadcast(blocks), "block", "left")
              .select("text", "text_key", F.coalesce(bit == 1, F.lit(False)).alias("copied")))
    alone = marked.filter(~F.col("copied")).select("text")
    return alone.unionAll(marked.filter("copied").dropDuplicates(["text_key"]).select("text"))


def places(own: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, text_key, start, end, share): every place of every row of ``terms``
    (term, share) outside the base spans of all documents."""
    number = terms.count()
    known_bits, bits = bitmap(terms.select(F.crc32(F.encode("term", "UTF-8")).alias("h")), number)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, str | None] = {}

        def term(word: str) -> str | None:
            """The lower-case word if it may be a term."""
            low = word.lower()
            h = zlib.crc32(low.encode()) % bits
            if len(known) > 200_000:
                known.clear()
            known[word] = out = low if known_bits[h >> 3] >> (h & 7) & 1 else None
            return out

        for batch in batches if number else ():
            rows = []
            for doc_id, key, text in zip(batch["doc_id"], batch["text_key"], batch["text"],
                                         strict=True):
                if not text:
                    continue
                for m in free_words(text, base_spans(text)):
                    word = m[0]
                    t = known[word] if word in known else term(word)
                    if t is not None:
                        rows.append((doc_id, key, t, *m.span()))
            if rows:
                out = pd.DataFrame(rows, columns=["doc_id", "text_key", "term", "start", "end"])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    at = own.mapInPandas(run, "doc_id long, text_key long, term string, start int, end int")
    return at.join(terms, "term").select("doc_id", "text_key", "start", "end", "share")


def find_spans(docs: DataFrame, support: int = 2, generalise_at: float = 0.8,
               remove_at: float = 0.95) -> DataFrame:
    """One row per document: doc_id, text_key (xxhash64 of the text), n_email,
    n_ip, n_card, n_phone, ``base`` (base spans as kind:start:end) and ``added``
    (spans of disclosing terms: arrays of start, end, kind).

    Null and empty texts have no spans. Repeated rows and copies of a text get the
    same spans, and count once as evidence. Null doc_ids stay. An empty table gives
    an empty result. Only doc_id and text are read. Offsets are code points.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.col("text").cast("string").alias("text")).withColumn(
        "text_key", F.xxhash64("text"))
    found = staged(own.mapInPandas(_find, _FOUND), "pii-found")
    shares = disclosure(own, found, support).filter(F.col("share") >= generalise_at)
    terms = staged(shares.groupBy("term").agg(F.max("share").alias("share")), "pii-terms")
    added = (places(own, terms).distinct()
             .groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(F.struct(
                 "start", "end", F.when(F.col("share") >= remove_at, ADDED[0])
                 .otherwise(ADDED[1]).alias("kind")))).alias("added")))
    return (found.drop("entities", "words").alias("f").join(
        added.alias("a"), F.expr("f.doc_id <=> a.doc_id AND f.text_key = a.text_key"), "left")
        .select("f.*", "a.added"))


def all_spans(base: Column, added: Column) -> Column:
    """``base`` and ``added`` spans as one string, by start, then kind as listed."""
    kinds = F.array(*map(F.lit, KINDS + ADDED))
    of_base = F.transform(F.filter(F.split(base, ","), lambda s: s != ""), lambda s: F.struct(
        F.split(s, ":")[1].cast("int").alias("start"),
        F.array_position(kinds, F.split(s, ":")[0]).alias("k"), s.alias("text")))
    of_added = F.transform(F.coalesce(added, F.array()), lambda x: F.struct(
        x["start"].alias("start"), F.array_position(kinds, x["kind"]).alias("k"),
        F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
        .alias("text")))
    both = F.array_sort(F.concat(of_base, of_added))
    return F.array_join(F.transform(both, lambda x: x["text"]), ",")


def redact(text: str | None, base: str, added) -> str | None:
    """``text`` with base spans as [KIND], removed terms gone and generalised ones
    as [NUMBER], [NAME] or [WORD]. Where spans overlap, the first one stands
    for their union."""
    if not text:
        return text
    spans = []
    for s in filter(None, (base or "").split(",")):
        kind, a, b = s.split(":")
        spans.append((int(a), int(b), f"[{kind.upper()}]"))
    for x in added if added is not None else []:
        term = text[x["start"]:x["end"]]
        name = "NUMBER" if term.isdigit() else "NAME" if term[:1].isupper() else "WORD"
        spans.append((x["start"], x["end"], "" if x["kind"] == ADDED[0] else f"[{name}]"))
    out, done = [], 0
    for a, b, sign in sorted(spans):
        if a >= done:
            out += [text[done:a], sign]
        done = max(done, b)
    return "".join([*out, text[done:]])


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with sanitised texts, in the same columns (``n_chars`` follows)."""
    spans = find_spans(docs, **options).select("doc_id", "text_key", "base", "added")
    spans = spans.filter("base <> '' OR added IS NOT NULL").dropDuplicates(["doc_id", "text_key"])
    joined = docs.alias("d").join(spans.alias("s"), F.expr(
        "cast(d.doc_id as bigint) <=> s.doc_id AND xxhash64(d.text) = s.text_key"), "left")

    @F.pandas_udf("string")
    def clean(text: pd.Series, base: pd.Series, added: pd.Series) -> pd.Series:
        return pd.Series([redact(t, b, a) for t, b, a in zip(text, base, added, strict=True)],
                         dtype=object)

    joined = joined.withColumn("clean_text", F.when(
        F.col("s.base").isNull(), F.col("d.text")).otherwise(clean("d.text", "s.base", "s.added")))
    out = joined.select(*[F.col(f"d.{c}") for c in docs.columns if c not in ("text", "n_chars")],
                        F.col("clean_text").alias("text"),
                        *([F.length("clean_text").cast("long").alias("n_chars")]
                          if "n_chars" in docs.columns else []))
    return out.select(*docs.columns)
