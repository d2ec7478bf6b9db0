"""Faceted catalogue search: predicates built only from the arguments given, stable paging, capped counts."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoneda.functions.normalize import file_number, fold, fold_compat, plain_word
from almoneda.functions.spanish import lexeme, lexemes

CAP, PAGE = 5000, 25
SORTS = ("fecha_fin_plazo", "fecha_publicacion", "valor_estimado")


def text_terms(query: str) -> list[tuple[str, list[str]]]:
    """(kind, words) of a web-style query: words are all needed, "quoted ones" in a row, -without, OR between neighbours."""
    parts, out, either = re.findall(r'-?"[^"]*"|\S+', query), [], False
    for p in parts:
        if p.upper() == "OR" and out:
            either = True
            continue
        kind = "not" if p.startswith("-") and len(p) > 1 else "and"
        words = re.findall(r"\w+", p.lower())
        if words:
            kind = "or" if either and kind == "and" else kind
            out.append((kind, words))
        either = False
    return out


def tokens(*columns: str) -> Column:
    """Folded words of several columns, in order; a break between columns keeps phrases within one."""
    text = F.concat_ws(" \x01 ", *[F.col(c) for c in columns])
    return F.regexp_extract_all(fold(text), F.lit(r"([\p{L}\p{N}_]+|\x01)"), F.lit(1))


def matches(words: Column, query: str, stems: bool = False) -> Column:
    """Whether an array of folded words matches the query; with ``stems`` an array of lexemes, and stop words ask for nothing. An empty query
    matches all."""

    def has(ws: list[str]) -> Column | None:
        said = [lexeme(plain_word(w)) for w in ws] if stems else ws
        asked = [w for w in said if w]
        if not asked:
            return None
        plain = [F.lit(w) if stems else fold(F.lit(w)) for w in said]
        found = reduce(lambda a, b: a & b, [F.array_contains(words, F.lit(w) if stems else fold(F.lit(w))) for w in asked])
        return found if len(ws) == 1 else found & F.contains(F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" ")), F.concat(F.lit(" "), F.concat_ws(" ", *plain), F.lit(" ")))

    groups: list[Column] = []
    for kind, ws in text_terms(query):
        c = has(ws)
        if c is None:
            continue
        if kind == "or" and groups:
            groups[-1] = groups[-1] | c
        else:
            groups.append(~c if kind == "not" else c)
    return reduce(lambda a, b: a & b, groups, F.lit(True))


def has_prefix(codes: str, prefixes: list[str]) -> Column:
    return F.exists(codes, lambda x: reduce(lambda a, b: a | b, [x.startswith(p) for p in prefixes]))


@dataclass
class Search:
    """What to look for; what is None or empty doesn't filter. ``as_of`` stands for now. ``lexemas`` names a column of lexemes, written with the
    catalogue, that texts are looked for in; without one, whole words are."""

    texto: str = ""
    lexemas: str = ""
    prefijos: list[str] = field(default_factory=list)
    codigos: list[str] = field(default_factory=list)
    expediente: str = ""
    fuente: str | None = None
    desiertas: str | None = None
    importe: tuple[float | None, float | None] = (None, None)
    fin: tuple[datetime | None, datetime | None] = (None, None)
    publicacion: tuple[datetime | None, datetime | None] = (None, None)
    estado: str | None = None
    orden: str = "fecha_fin_plazo"
    descendente: bool = False
    pagina: int = 1
    por_pagina: int = PAGE
    as_of: datetime | None = None

    def _others(self) -> bool:
        return any([self.texto, self.prefijos, self.codigos, self.expediente, self.fuente, self.desiertas, *self.importe, *self.fin, *self.publicacion])

    def predicate(self) -> Column:
        c: list[Column] = []
        if self.texto.strip():
            c.append(matches(F.col(self.lexemas), self.texto, True) if self.lexemas else matches(tokens("titulo", "objeto", "organo_contratacion"), self.texto))
        if self.prefijos:
            c.append(F.coalesce(has_prefix("cpv", self.prefijos), F.lit(False)))
        if self.codigos:
            c.append(F.coalesce(F.arrays_overlap("cpv", F.array(*map(F.lit, self.codigos))), F.lit(False)))
        fragment = re.sub(r"[\s/.\-]", "", self.expediente).upper()
        if len(fragment) >= 3:
            c.append(F.contains(file_number("num_expediente"), F.lit(fragment)))
        if self.fuente:
            c.append(F.col("fuente") == self.fuente)
        states = {"todas": ["desierta_total", "desierta_parcial"], "total": ["desierta_total"], "parcial": ["desierta_parcial"]}.get(self.desiertas or "")
        if states:
            c.append(F.col("estado_adjudicacion").isin(*states))
        for name, (lo, hi) in (("valor_estimado", self.importe), ("fecha_fin_plazo", self.fin), ("fecha_publicacion", self.publicacion)):
            lit = F.lit if name == "valor_estimado" else (lambda v: F.lit(v).cast("timestamp_ntz"))
            c += [F.col(name) >= lit(lo)] if lo is not None else []
            c += [F.col(name) <= lit(hi)] if hi is not None else []
        state = self.estado or ("todas" if self._others() else "abierta")
        if state in ("abierta", "cerrada"):
            if self.as_of is None:
                raise ValueError("open and closed are as of a moment: give as_of")
            now = F.lit(self.as_of).cast("timestamp_ntz")
            c.append(F.col("fecha_fin_plazo") >= now if state == "abierta" else F.col("fecha_fin_plazo") < now)
        return reduce(lambda a, b: a & b, c, F.lit(True))

    def order(self) -> list[Column]:
        by = F.col(self.orden if self.orden in SORTS else SORTS[0])
        return [by.desc_nulls_last() if self.descendente else by.asc_nulls_last(), F.col("licitacion_id").asc()]


def with_lexemes(df: DataFrame, name: str = "lexemas") -> DataFrame:
    """Adds the lexemes of title, object and buyer, for a catalogue that is about to be written."""
    return df.withColumn(name, lexemes(tokens("titulo", "objeto", "organo_contratacion")))


def hits(df: DataFrame, s: Search) -> DataFrame:
    return df.where(s.predicate())


def page(df: DataFrame, s: Search) -> DataFrame:
    """One page in a total order: plans as a bounded top-k, never a full sort."""
    size = max(1, s.por_pagina)
    return hits(df, s).orderBy(*s.order()).offset((max(1, s.pagina) - 1) * size).limit(size)


def capped_count(df: DataFrame, s: Search, cap: int = CAP) -> DataFrame:
    """total and whether it was capped: at most cap + 1 rows are counted."""
    n = hits(df, s).limit(cap + 1).agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.least("n", F.lit(cap).cast("long")).alias("total"), (F.col("n") > cap).alias("topado"))


def first_match(title: str, codes: str, criteria: list[tuple[str, list[str], list[str]]]) -> Column:
    """The first category, in order, with a code prefix or else a folded keyword in the title; null if none."""
    out = F.lit(None).cast("string")
    for name, prefixes, keywords in reversed(criteria):
        by_code = F.coalesce(has_prefix(codes, prefixes), F.lit(False)) if prefixes else F.lit(False)
        by_word = reduce(lambda a, b: a | b, [F.contains(fold_compat(title), fold_compat(F.lit(k))) for k in keywords], F.lit(False))
        out = F.when(by_code | F.coalesce(by_word, F.lit(False)), F.lit(name)).otherwise(out)
    return out


def coerced(params: dict, as_of: datetime) -> Search:
    """A search from loose parameters: what isn't a finite number, a date, a text that isn't blank or a known word is ignored; pages count
    from 1."""

    def number(v: object) -> float | None:
        try:
            x = float(str(v).strip())
        except ValueError:
            return None
        return x if math.isfinite(x) else None

    def moment(v: object) -> datetime | None:
        if isinstance(v, datetime):
            return v
        try:
            return datetime.fromisoformat(str(v).strip())
        except ValueError:
            return None

    def text(v: object) -> str:
        return v.strip() if isinstance(v, str) else ""

    def many(v: object) -> list[str]:
        return [t for x in (v if isinstance(v, list) else [v]) if (t := text(x))]

    def whole(v: object, default: int) -> int:
        x = number(v)
        return max(1, int(x)) if x is not None else default

    get = params.get
    prefixes = [t for x in many(get("prefijos")) for p in re.split(r"[,;\s]+", x) if (t := p.partition("-")[0].strip())]
    estado = get("estado") if get("estado") in ("abierta", "cerrada", "todas") else None
    return Search(
        texto=text(get("texto")), prefijos=prefixes, codigos=many(get("codigos")), expediente=text(get("expediente")), fuente=text(get("fuente")) or None, desiertas=get("desiertas") if get("desiertas") in ("todas", "total", "parcial") else None,
        importe=(number(get("importe_min")), number(get("importe_max"))), fin=(moment(get("fin_desde")), moment(get("fin_hasta"))), publicacion=(moment(get("publicacion_desde")), moment(get("publicacion_hasta"))), estado=estado,
        orden=get("orden") if get("orden") in SORTS else SORTS[0], descendente=get("descendente") is True, pagina=whole(get("pagina"), 1), por_pagina=whole(get("por_pagina"), PAGE), as_of=as_of)


@dataclass
class Found:
    """What a search gives: the page's rows and what is said about them."""

    rows: DataFrame
    total: int
    topado: bool
    pagina: int
    por_pagina: int

    @property
    def aproximado(self) -> bool:
        return self.topado

    @property
    def paginas(self) -> int:
        return max(1, -(-self.total // self.por_pagina))

    @property
    def mostradas(self) -> tuple[int, int]:
        """The first and last row shown, by number; (0, 0) of an empty page."""
        first = (self.pagina - 1) * self.por_pagina + 1
        last = first + self.por_pagina - 1 if self.topado else min(self.total, first + self.por_pagina - 1)
        return (first, last) if last >= first else (0, 0)

    @property
    def resumen(self) -> str:
        return f"{self.mostradas[0]}-{self.mostradas[1]} de {self.total}{'+' if self.topado else ''}"

    def json(self) -> DataFrame:
        """One row: the envelope as JSON, its rows in their order (a page of them)."""
        listed = self.rows.withColumn("__n", F.monotonically_increasing_id()).agg(F.array_sort(F.collect_list(F.struct("__n", F.struct(*self.rows.columns).alias("r")))).alias("l"))
        return listed.select(F.to_json(F.struct(F.lit(self.total).alias("total"), F.transform("l", lambda x: x["r"]).alias("filas"), F.lit(self.pagina).alias("pagina"), F.lit(self.por_pagina).alias("porPagina"), F.lit(self.aproximado).alias("aproximado"), F.lit(self.topado).alias("topado"))).alias("json"))


def run(df: DataFrame, s: Search, cap: int = CAP, by_text: bool = False) -> Found:
    """The search's envelope: the count stops one above ``cap``, the page is a bounded top-k; both read the same pushed-down filter. With
    ``by_text`` a search without text, prefix or a file number of three signs is refused."""
    number = re.sub(r"[\s/.\-]", "", s.expediente)
    if by_text and not (s.texto.strip() or s.prefijos or len(number) >= 3):
        raise ValueError("a text, a code prefix or three signs of a file number are needed")
    total, over = capped_count(df, s, cap).first()
    return Found(page(df, s), total, over, max(1, s.pagina), max(1, s.por_pagina))
