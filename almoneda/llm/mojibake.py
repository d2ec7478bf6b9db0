"""Text decoded with the wrong character encoding: found and restored through a table of garbled forms of the corpus' own words.

Every distinct word of the corpus is garbled under all encoding chains; the garbled forms are hash-joined with the distinct words. A
word that is another, better attested word's garbled form is a candidate; candidates are verified by the chain's round trip, by how
often either form occurs and by what else the document holds; verified originals are substituted. Copies of a text count once, and
what decodes as UTF-8 to characters of the corpus is garbled however often it occurs.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almoneda.plans.runtime import materialize, maybe_broadcast

#: Encodings texts are written in, and those they are wrongly read in.
WRITTEN = ("utf-8", "cp1252", "mac_roman", "cp850", "cp437")
READ = ("cp1252", "latin-1", "cp1250", "cp1251", "cp437", "cp850", "mac_roman", "utf-8")

#: A word: ASCII letters and anything beyond ASCII. Garbling leaves ASCII as it is, so ASCII digits and punctuation separate.
#: The look-behind and the possessive repeats let every place be tried once only, so that long runs of letters cost no more than their length.
WORD = r"(?<![A-Za-z\x{80}-\x{10FFFF}])[A-Za-z]*+[\x{80}-\x{10FFFF}][A-Za-z\x{80}-\x{10FFFF}]*+"
_WORD = re.compile(r"(?<![A-Za-z\x80-\U0010FFFF])[A-Za-z]*+[\x80-\U0010FFFF][A-Za-z\x80-\U0010FFFF]*+")
#: Marks a chain whose invisible characters were lost afterwards.
LOST = "-"
_UNSEEN = re.compile("[\x80-\x9f\xad]")
_RUN = r"[\x{80}-\x{10FFFF}]+"


def chains() -> list[tuple[str, ...]]:
    """(written, read) pairs, and UTF-8 misread twice."""
    once = [(w, r) for w in WRITTEN for r in READ if w != r and not (w == "cp1252" and r == "latin-1")]
    twice = [("utf-8", a, "utf-8", b) for a in ("cp1252", "latin-1") for b in ("cp1252", "latin-1")]
    return once + twice


@lru_cache(32)
def _decoding(name: str) -> dict[int, str]:
    """A byte's character; bytes the code page leaves out stand for the control characters of that number."""
    out = {}
    for b in range(256):
        try:
            out[b] = bytes([b]).decode(name)
        except UnicodeDecodeError:
            out[b] = chr(b)
    return out


@lru_cache(32)
def _encoding(name: str) -> dict[str, int]:
    return {c: b for b, c in _decoding(name).items()}


def _encode(text: str, name: str) -> bytes | None:
    if name == "utf-8":
        try:
            return text.encode("utf-8")
        except UnicodeEncodeError:
            return None
    table = _encoding(name)
    try:
        return bytes([table[c] for c in text])
    except KeyError:
        return None


def _decode(data: bytes, name: str) -> str:
    if name == "utf-8":
        return data.decode("utf-8", "replace")
    table = _decoding(name)
    return "".join([table[b] for b in data])


def garble(text: str, chain: tuple[str, ...]) -> str | None:
    """The text as the chain makes it, or None if it can't be written that way or isn't changed."""
    out: str | None = text
    for w, r in zip(chain[::2], chain[1::2], strict=True):
        data = _encode(out, w)
        if data is None:
            return None
        out = _decode(data, r)
    return None if out == text else out


def ungarble(text: str, chain: tuple[str, ...]) -> str | None:
    """The text that the chain turns into this one, or None. Lossy chains (read as UTF-8 with replacements) have no inverse."""
    out = text
    if chain[-1] == LOST:
        return None
    for w, r in reversed(list(zip(chain[::2], chain[1::2], strict=True))):
        if r == "utf-8":
            return None
        data = _encode(out, r)
        if data is None:
            return None
        try:
            out = data.decode("utf-8") if w == "utf-8" else _decode(data, w)
        except UnicodeDecodeError:
            return None
    return out if out != text and garble(out, chain) == text else None


def _forms(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    every = [(c, "|".join(c)) for c in chains()]
    for b in batches:
        out = []
        for w, fragment in zip(b["w"], b["parte"], strict=True):
            for chain, name in every:
                g = garble(w, chain)
                # A fragment (characters beyond ASCII, without the word around them) tells something only if it became a sequence.
                if g is not None and (not fragment or len(g) > len(w) or "�" in g):
                    out.append((g, w, name, fragment))
                    # Invisible characters of a garbled form may have been lost since.
                    if not fragment and (bare := _UNSEEN.sub("", g)) != g and bare and not bare.isascii():
                        out.append((bare, w, f"{name}|{LOST}", False))
        yield pd.DataFrame(out, columns=["g", "w", "chain", "parte"])


#: Chains whose way back proves itself: chance hardly makes bytes that decode strictly as UTF-8. Two signs of other characters than
#: Western Europe's may do so by chance («ú is ǜ in Mac Roman), three together don't.
_SURE = [c for c in chains() if set(c[::2]) == {"utf-8"}]
_USUAL = frozenset(_encoding("cp1252")) - {chr(b) for b in range(0xA0)}
_LONG = 3


def _inverses(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = [(r, back, "|".join(c)) for r in b["r"] for c in _SURE if (back := ungarble(r, c)) is not None and (len(back) >= _LONG or _USUAL.issuperset(back))]
        yield pd.DataFrame(out, columns=["r", "original", "chain"])


def words(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, texto, ws): the distinct words beyond ASCII of each document that has any; ``texto`` is equal for equal texts only."""
    ws = F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(f"({WORD})"), F.lit(1)))
    return docs.select(F.col(key).alias("doc"), F.sha2(text, 256).alias("texto"), ws.alias("ws")).where(F.size("ws") > 0)


def sure_runs(runs: DataFrame) -> DataFrame:
    """(r, chains): of the distinct runs (r), those that lead back, strictly decoded as UTF-8, to characters that occur in runs without
    such a way back. Of several ways back that through most misreadings counts."""
    inverse = materialize(runs.repartition("r").mapInPandas(_inverses, "r string, original string, chain string"), "inverses")
    signs = lambda c: F.explode(F.array_distinct(F.regexp_extract_all(c, F.lit("(?s)(.)"), F.lit(1)))).alias("c")
    attested = runs.join(inverse, "r", "left_anti").select(signs("r")).distinct()
    unknown = inverse.select("r", "original", signs("original")).join(attested, "c", "left_anti").select("r", "original").distinct()
    same = inverse.join(unknown, ["r", "original"], "left_anti").groupBy("r", F.length("original").alias("n")).agg(F.collect_set("chain").alias("chains"))
    return same.groupBy("r").agg(F.min_by("chains", "n").alias("chains"))


def better_attested(pairs: DataFrame, of_word: DataFrame, counts: DataFrame, ratio: float, letters: int, alone: float) -> DataFrame:
    """(w, original, chains, fuerte): the garbled words by the counts (w, u, n as an original, u_g, n_g as a garbled form)."""
    runs = of_word.join(counts, "w").groupBy(F.col("r").alias("w")).agg(*[F.sum(c).alias(c) for c in ("u", "n", "u_g", "n_g")]).withColumn("parte", F.lit(True))
    known = materialize(counts.withColumn("parte", F.lit(False)).unionByName(runs), "attestation")
    original, form = known.select("w", "parte", "u", "n"), known.select(F.col("w").alias("g"), "parte", "u_g", "n_g")
    fits = (F.col("n") >= F.col("n_g") * ratio) & (F.col("u") >= F.col("u_g"))
    found = pairs.join(original, ["w", "parte"]).join(form, ["g", "parte"]).where(fits)
    best = materialize(found.groupBy("g", "parte").agg(F.max_by(F.struct("w", "chains", "n", "n_g"), F.struct("n", "w")).alias("o")), "verified")
    strong = (F.length(F.regexp_replace(F.col("o.w"), "[^A-Za-z]", "")) >= letters) | ((F.col("o.n") >= F.col("o.n_g") * alone) & ~F.col("g").rlike(r"^\p{Z}+$"))
    by_word = best.where(~F.col("parte")).select(F.col("g").alias("w"), F.col("o.w").alias("original"), F.col("o.chains").alias("chains"), strong.alias("fuerte"))
    return by_word.unionByName(_by_run(of_word, best.where("parte").select(F.col("g").alias("r"), F.col("o.chains").alias("chains"))))


def _by_run(of_word: DataFrame, runs: DataFrame) -> DataFrame:
    held = of_word.join(runs, "r").groupBy("w").agg(F.array_distinct(F.flatten(F.collect_list("chains"))).alias("chains"))
    return held.select("w", F.lit(None).cast("string").alias("original"), "chains", F.lit(True).alias("fuerte"))


def _together(found: DataFrame) -> DataFrame:
    return found.groupBy("w").agg(F.max("original").alias("original"), F.array_distinct(F.flatten(F.collect_list("chains"))).alias("chains"), F.max("fuerte").alias("fuerte"))


def garbled_words(by_text: DataFrame, ratio: float = 3.0, letters: int = 2, alone: float = 200.0) -> DataFrame:
    """(w, original, chains, fuerte): the corpus words that are garbled, from (texto, w, copias), the words of each distinct text.

    A word is garbled if it holds a fragment (a run of characters beyond ASCII) that decodes strictly as UTF-8 to characters of the corpus,
    however often it occurs; such a word is nobody's original. Else it is garbled if it is the garbled form of a word found in at least
    ``ratio`` times as many distinct texts, or holds a fragment that is the garbled sequence of a run found that much more often. Where
    distinct texts don't tell, copies do, but only those of texts not yet found garbled, and not against the distinct texts. ``fuerte``
    tells a match that can stand alone: one by fragment, or of a word with at least ``letters`` ASCII letters, or of a shorter one (a
    currency sign, a dash) whose original is found ``alone`` times as often; any other lone symbol, and a lone space, may well stand for itself.
    """
    vocabulary = materialize(by_text.select("w").distinct(), "words")
    of_word = materialize(vocabulary.select("w", F.explode(F.array_distinct(F.regexp_extract_all("w", F.lit(f"({_RUN})"), F.lit(1)))).alias("r")), "runs")
    runs = of_word.select("r").distinct()
    sure = materialize(sure_runs(runs), "sure-runs")
    proven = materialize(_by_run(of_word, sure), "proven-words")
    targets = vocabulary.withColumn("parte", F.lit(False)).unionByName(runs.select(F.col("r").alias("w"), F.lit(True).alias("parte")))
    originals = vocabulary.join(proven, "w", "left_anti").withColumn("parte", F.lit(False)).unionByName(runs.join(sure, "r", "left_anti").select(F.col("r").alias("w"), F.lit(True).alias("parte")))
    forms = originals.repartition("w").mapInPandas(_forms, "g string, w string, chain string, parte boolean")
    # Chains that give the same form from the same word stand together; there are a few dozen chains.
    pairs = forms.join(targets.withColumnRenamed("w", "g"), ["g", "parte"]).groupBy("g", "parte", "w").agg(F.collect_set("chain").alias("chains"))
    pairs = materialize(pairs, "pairs")
    once = by_text.groupBy("w").agg(F.count(F.lit(1)).alias("u")).select("w", "u", F.col("u").alias("n"), F.col("u").alias("u_g"), F.col("u").alias("n_g"))
    first = materialize(_together(better_attested(pairs, of_word, once, ratio, letters, alone).unionByName(proven)), "garbled-by-text")
    garbled = by_text.join(maybe_broadcast(first.where("fuerte").select("w")), "w").select("texto").distinct().withColumn("malo", F.lit(1))
    sound = by_text.join(garbled, "texto", "left").withColumn("bueno", 1 - F.coalesce("malo", F.lit(0)))
    copies = sound.groupBy("w").agg(F.sum("bueno").alias("u"), F.sum(F.col("bueno") * F.col("copias")).alias("n"), F.count(F.lit(1)).alias("u_g"), F.sum(F.when(F.col("bueno") == 1, F.col("copias")).otherwise(1)).alias("n_g"))
    rest = better_attested(pairs, of_word, copies, ratio, letters, alone).join(first.where("fuerte"), "w", "left_anti")
    return materialize(_together(first.unionByName(rest)), "garbled-words")


def garbled_documents(docs: DataFrame, key: str, text: str, ratio: float = 3.0) -> DataFrame:
    """(doc, cambios): the documents that hold garbled words, with those words, their originals and chains.

    Null, empty and pure ASCII texts are never garbled. Repeated documents are judged each; however many, they attest nothing against
    themselves. An empty table gives no rows. Texts are used whole. Other columns aren't read.
    """
    by_doc = materialize(words(docs, key, text), "document-words")
    texts = by_doc.groupBy("texto").agg(F.first("ws").alias("ws"), F.count(F.lit(1)).alias("copias"))
    by_text = materialize(texts.select("texto", "copias", F.explode("ws").alias("w")), "text-words")
    bad = garbled_words(by_text, ratio)
    hits = by_text.join(maybe_broadcast(bad), "w")
    # A text's hits are at most the distinct words of its own.
    per_text = hits.groupBy("texto").agg(F.max("fuerte").alias("fuerte"), F.collect_list(F.struct("w", "original", "chains", "fuerte")).alias("cambios"))
    found = materialize(per_text.where("fuerte").select("texto", "cambios"), "garbled-texts")
    per_doc = by_doc.select("doc", "texto").distinct().join(maybe_broadcast(found), "texto")
    return per_doc.groupBy("doc").agg(F.array_distinct(F.flatten(F.collect_list("cambios"))).alias("cambios"))


#: The letters beyond ASCII of the languages at hand.
LETTERS = frozenset("áéíóúüñçàèòïãõâêôÁÉÍÓÚÜÑÇÀÈÒÏÃÕÂÊÔªº")


def _unattested(word: str, chain: str) -> str:
    """A word that no other text attests, in a text garbled by the chain: led back if it has a sign that isn't a letter of the languages at hand
    and the way back has only such letters, between quotes perhaps; else it may well be sound, and stays."""
    odd = [c for c in word if c > "\x7f"]
    if len(word) - len(odd) < 2 or LETTERS.issuperset(odd):
        return word
    back = ungarble(word, tuple(chain.split("|")))
    return back if back is not None and all(c <= "\x7f" or c in LETTERS for c in back.strip("«»“”‘’…")) else word


def restore_text(text: str, changes: list[tuple[str, str | None, list[str], bool]]) -> str:
    """Substitutes garbled words by their originals. A word without an attested original is led back through the chain that most of
    the document's garbled words share, if that goes there and back again; else it stays. So is a word that occurs nowhere else."""
    votes: dict[str, int] = {}
    for _, _, names, strong in changes:
        if strong:
            for c in names:
                votes[c] = votes.get(c, 0) + 1
    order = sorted(votes, key=lambda c: (-votes[c], c))
    table: dict[str, str] = {}
    for w, original, names, strong in changes:
        if original is not None and (strong or any(c in votes for c in names)):
            table[w] = original
        else:
            for c in order:
                if c in names and (back := ungarble(w, tuple(c.split("|")))) is not None:
                    table[w] = back
                    break
    first = order[0] if order else None
    return _WORD.sub(lambda m: table[m[0]] if m[0] in table else _unattested(m[0], first) if first else m[0], text)


def restored_documents(docs: DataFrame, key: str, text: str, ratio: float = 3.0) -> DataFrame:
    """(doc, text): garbled documents with the original text, as far as it can be recovered."""
    found = materialize(garbled_documents(docs, key, text, ratio), "garbled-documents")
    both = docs.select(F.col(key).alias("doc"), F.col(text).alias("text")).join(maybe_broadcast(found), "doc")

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [restore_text(t, [(c["w"], c["original"], list(c["chains"]), c["fuerte"]) for c in ch]) for t, ch in zip(b["text"], b["cambios"], strict=True)]
            yield pd.DataFrame({"doc": b["doc"], "text": out})

    return both.mapInPandas(run, "doc long, text string")
