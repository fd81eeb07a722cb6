"""Fill-in-middle transformation by a table-driven automaton over UTF-8 bytes.

1. The table gives, for each state and byte, the next state and what the step emits: the start of a unit, the
   start of a character, the end of a sentinel. Bytes that continue a character emit nothing.
2. The automaton forgets what is further back than the longest sentinel less one byte, so the state before every
   byte of a chunk comes from that many table look-ups of its predecessors, for all bytes at once.
3. The first scan keeps how often each emission occurred in each chunk of a text; that gives units, characters and
   sentinels. The second looks only into the chunks where the cuts fall.
4. Spark draws the cuts and the form from a hash of the id and puts the parts together; only numbers leave Python.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from claimforge.llm.common import tag

SENTINELS = ("<P>", "<S>", "<M>")
#: Of 100 documents so many stay plain, and of 100 others so many have the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20
#: Bytes of a text that are scanned at a time.
CHUNK = 1 << 20
UNIT, CHARACTER, SENTINEL = 1, 2, 4

CUTS = StructType([StructField(c, LongType()) for c in ("n", "sentinels", "prefix_chars", "middle_chars")])


class Automaton:
    """``follow`` and ``emit`` by state and byte, for units ``[A-Za-z]+|[^A-Za-z]`` and given sentinels of ASCII.

    State 0 is the start: no open word and no begun sentinel; state 1 is a word; every other state is a begun or just ended
    sentinel, and is in a word if its last character is a letter.
    """

    def __init__(self, sentinels: tuple[str, ...] = SENTINELS):
        words = [s.encode("ascii") for s in sentinels]
        if not all(words):
            raise ValueError("a sentinel is empty")
        begun = sorted({w[:n] for w in words for n in range(1, len(w) + 1)})
        state = {p: i for i, p in enumerate(begun, 2)}
        self.memory = max(1, *(len(w) - 1 for w in words))
        self.follow = np.zeros((len(begun) + 2, 256), np.uint8)
        self.emit = np.zeros_like(self.follow)
        letter = [chr(b).isascii() and chr(b).isalpha() for b in range(256)]
        for before, at in [(b"", 0), (b"", 1), *state.items()]:
            in_word = at == 1 or bool(before) and letter[before[-1]]
            for b in range(256):
                if 0x80 <= b < 0xC0:
                    continue  # continues a character: nothing starts, and the state is as after any other character
                read = before + bytes([b])
                end = next((state[read[i:]] for i in range(len(read)) if read[i:] in state), int(letter[b]))
                self.follow[at, b] = end
                self.emit[at, b] = CHARACTER | UNIT * (not (in_word and letter[b])) | SENTINEL * any(read.endswith(w) for w in words)

    def emitted(self, data: np.ndarray, start: int, stop: int) -> np.ndarray:
        """What the bytes from ``start`` to ``stop`` emit, read after those before them."""
        first = max(0, start - self.memory)
        # a byte that continues a character leaves the start state as it is: it stands for "before the text"
        window = np.concatenate([np.full(self.memory - (start - first), 0x80, np.uint8), data[first:stop]])
        n, states = stop - start, np.zeros(stop - start, np.uint16)
        for back in range(self.memory):
            states = self.follow.ravel()[states << 8 | window[back : back + n]].astype(np.uint16)
        return self.emit.ravel()[states << 8 | window[self.memory :]]

    def cuts(self, text: bytes, draws: tuple[int, int] | None) -> tuple[int, int, int | None, int | None]:
        """(units, sentinels, characters before the first cut, characters between the cuts) of a whole text.

        A draw modulo (units + 1) is the number of units before a cut. No cuts without draws or with sentinels.
        """
        data = np.frombuffer(text, np.uint8)
        starts = range(0, len(data), CHUNK)
        counts = np.array([np.bincount(self.emitted(data, i, min(i + CHUNK, len(data))), minlength=8) for i in starts], np.int64).reshape(-1, 8)
        of = lambda kind: counts[:, [e for e in range(8) if e & kind]].sum(axis=1)
        units, characters, sentinels = of(UNIT), of(CHARACTER), int(of(SENTINEL).sum())
        n = int(units.sum())
        if draws is None or sentinels or not n:
            return n, sentinels, None, None
        ends, at = np.cumsum(units), []
        for cut in sorted(d % (n + 1) for d in draws):
            if cut == n:
                at.append(int(characters.sum()))
                continue
            k = int(np.searchsorted(ends, cut, side="right"))
            found = self.emitted(data, k * CHUNK, min((k + 1) * CHUNK, len(data)))
            place = np.flatnonzero(found & UNIT)[cut - (int(ends[k - 1]) if k else 0)]
            at.append(int(characters[:k].sum()) + int(np.count_nonzero(found[:place] & CHARACTER)))
        return n, sentinels, at[0], at[1] - at[0]


def cut_points(text: Column, cut: Column, first: Column, second: Column, sentinels: tuple[str, ...]) -> Column:
    automaton = Automaton(sentinels)

    @F.arrow_udf(CUTS)
    def run(texts: pa.Array, cut: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
        drawn = zip(cut.to_pylist(), first.to_pylist(), second.to_pylist(), strict=True)
        made = [automaton.cuts(t.as_py() or b"", (a, b) if c else None) for t, (c, a, b) in zip(texts.cast(pa.binary()), drawn, strict=True)]
        columns = zip(*made, strict=True) if made else [()] * 4
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in columns], names=CUTS.names)

    return run(text, cut, first, second)


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 1, plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST, sentinels: tuple[str, ...] = SENTINELS) -> DataFrame:
    """``docs`` with ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and the transformed text in ``output``.

    Units are runs of A-Z and a-z, and every other character. ``form`` is ``plain`` (the text as it is, and no
    counts), ``psm`` (prefix, suffix, middle, each after its sentinel) or ``spm`` (suffix first). Cuts and form hang on the
    hash of seed and id alone. Texts that are null or empty (null is as empty) or hold a sentinel are plain.
    Rows of equal ids are drawn for alike, and a null id as an empty one. Texts are read whole, in chunks.
    Columns of ``docs`` with the names of results are replaced, all others stay. An empty table gives an empty one.
    """
    digest, drawn, points = tag("digest"), tag("drawn"), tag("points")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(docs[doc_id].cast("string"), F.lit("")))
    number = lambda i: F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long")
    whole = F.coalesce(docs[text], F.lit(""))
    rows = docs.withColumn(digest, F.sha2(key, 256)).withColumn(drawn, number(2) % 100 < 100 - plain)
    rows = rows.withColumn(points, cut_points(whole, F.col(drawn), number(0), number(1), sentinels))
    of = lambda name: F.col(points).getField(name)
    form = F.when(of("prefix_chars").isNull(), "plain").when(number(3) % 100 < suffix_first, "spm").otherwise("psm")
    p, s, m = map(F.lit, sentinels)
    before, between = of("prefix_chars").cast("int"), of("middle_chars").cast("int")
    prefix, middle = F.substring(whole, F.lit(1), before), F.substring(whole, before + 1, between)
    suffix = F.substr(whole, before + between + 1)
    output = F.when(form == "plain", whole).when(form == "psm", F.concat(p, prefix, s, suffix, m, middle)).otherwise(F.concat(s, suffix, p, prefix, m, middle))
    return rows.withColumns({"n": of("n"), "form": form, "prefix_chars": of("prefix_chars"), "middle_chars": of("middle_chars"), "output": output}).drop(digest, drawn, points)


def restored(output: Column, form: Column, sentinels: tuple[str, ...] = SENTINELS) -> Column:
    """The text that a transformed text was made of: the parts between the sentinels, put back in order."""
    p, s, m = sentinels

    def parts(one: str, two: str) -> tuple[Column, Column, Column]:
        a = F.lit(len(one) + 1)
        b = F.position(F.lit(two), output, a)
        c = F.position(F.lit(m), output, b + len(two))
        return F.substring(output, a, b - a), F.substring(output, b + len(two), c - b - len(two)), F.substr(output, c + len(m))

    (prefix, suffix, middle), (suffix2, prefix2, middle2) = parts(p, s), parts(s, p)
    return F.when(form == "plain", output).when(form == "psm", F.concat(prefix, middle, suffix)).otherwise(F.concat(prefix2, middle2, suffix2))


def op12_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    """Digests of all ``documents`` in their fill-in-middle forms, and of the texts rebuilt from these."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    made = fill_in_middle(docs)
    back = restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


OP12_SQL = r"""
with a as (select doc_id, coalesce(text, '') as text, sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents),
b as (select *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') as t, ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2,
  ('0x' || substr(h, 17, 8))::bigint as h3, ('0x' || substr(h, 25, 8))::bigint as h4 from a),
c as (select *, len(t) as n, least(h1 % (len(t) + 1), h2 % (len(t) + 1)) as i, greatest(h1 % (len(t) + 1), h2 % (len(t) + 1)) as j,
  case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from b),
d as (select *, array_to_string(t[1:i], '') as prefix, array_to_string(t[i + 1:j], '') as middle, array_to_string(t[j + 1:n], '') as suffix from c),
e as (select *, case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end as output from d)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars, case when form <> 'plain' then length(middle) end as middle_chars,
  sha256(output) as output_sha256, sha256(case when form = 'plain' then text else prefix || middle || suffix end) as restored_sha256 from e
"""
