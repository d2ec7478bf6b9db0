"""Views over catalogue, awards, competitors and decisions: dossiers, rivals, comparison, tabs, radar, facets, look-ups."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almoneda.functions.normalize import cif, fold_upper
from almoneda.operators.search import first_match
from almoneda.plans.runtime import maybe_broadcast


def point(df: DataFrame, key: str, value: object) -> DataFrame:
    """The row of that key, or none; the filter reaches the scan. More than one row is an error, found when the rows are read."""
    found = df.where(F.col(key) == F.lit(value)).limit(2).withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))))  # two rows at most
    return found.where(F.when(F.col("__n") > 1, F.raise_error(F.lit(f"{key} isn't unique"))).otherwise(F.lit(True)).cast("boolean")).drop("__n")


def look_up(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of those keys, each once however often a key is asked for; null keys ask for nothing."""
    return df.join(maybe_broadcast(keys.select(key).where(F.col(key).isNotNull()).distinct()), key, "left_semi")


def territory(platform: str, region: str, platforms: Iterable[str] = (), regions: Iterable[str] = ()) -> Column:
    """Whether a row is of the platforms and of the regions wanted; an empty list wants all. A null platform is the state's own."""
    p, r = list(platforms), list(regions)
    keep = F.coalesce(F.col(platform), F.lit("Estado")).isin(p) if p else F.lit(True)
    return keep & (F.coalesce(F.col(region).isin(r), F.lit(False)) if r else F.lit(True))


def active_terms(terms: object) -> list[str]:
    """The terms switched on in a configured list: texts, or {"v": text, "on": bool}; blank ones and other things are skipped."""
    out = []
    for t in terms if isinstance(terms, list) else []:
        v = t.get("v") if isinstance(t, dict) and t.get("on", True) else t
        if isinstance(v, str) and v.strip():
            out.append(v.strip())
    return out


def active_criteria(config: dict, fallback: list[tuple[str, list[str], list[str]]]) -> list[tuple[str, list[str], list[str]]]:
    """(category, code prefixes, keywords) of a configuration, in its order; without any usable category the fallback."""
    found = []
    for name, c in (config.get("categorias") or {}).items() if isinstance(config.get("categorias"), dict) else []:
        if isinstance(c, dict):
            codes, words = active_terms(c.get("cpv")), active_terms(c.get("palabras_clave"))
            if codes or words:
                found.append((name, codes, words))
    return found or fallback


def radar(rows: DataFrame, title: str, codes: str, criteria: list, allowed: Column, sources: Iterable[str] = ()) -> DataFrame:
    """Rows of a wanted category with ``categoria``: the source first, then the category, then the territory (``allowed``); a row outside the
    territory goes, whatever other category it might have. Used for new rows and to prune stored ones."""
    wanted = list(sources)
    df = rows.where(F.col("fuente").isin(wanted)) if wanted else rows
    return df.withColumn("categoria", first_match(title, codes, criteria)).where(F.col("categoria").isNotNull() & allowed)


def is_identifier(term: str) -> bool:
    """Whether a search term goes to a dossier rather than to the names: eight to ten letters and digits, with a digit."""
    t = "".join(c for c in term.upper() if c not in "./-" and not c.isspace())
    return 8 <= len(t) <= 10 and t.isascii() and t.isalnum() and any(c.isdigit() for c in t)


def find_competitors(c: DataFrame, term: str = "") -> DataFrame:
    """By amount: of an identifier its record, of a name those that hold it folded (wild cards stand for themselves), without a term
    the 20 largest; 50 at most with one."""
    order = [F.desc_nulls_last("importe_total_sin_iva"), F.asc("cif"), F.asc("ficha_id")]
    if not term.strip():
        return c.orderBy(*order).limit(20)
    if is_identifier(term):
        return c.where(cif("cif") == cif(F.lit(term))).orderBy(*order)
    return c.where(F.contains(fold_upper("nombre_busqueda"), fold_upper(F.lit(term.strip())))).orderBy(*order).limit(50)


def dossiers(awards: DataFrame, most: int = 1000, by_amount: bool = False) -> DataFrame:
    """Each winner's awards with their place: newest first, or largest first (an amount of 0 counts as none); ``most`` a winner. The limit
    is pushed below the shuffle."""
    amount = F.nullif("importe_sin_iva", F.lit(0).cast("decimal(20,2)"))
    order = [F.desc_nulls_last(amount)] if by_amount else []
    w = Window.partitionBy("cif_adjudicatario").orderBy(*order, F.desc_nulls_last("fecha_adjudicacion"), "licitacion_id", "lote")
    return awards.where("cif_adjudicatario <> ''").withColumn("puesto", F.row_number().over(w)).where(F.col("puesto") <= most)


def met(decisions: DataFrame, awards: DataFrame, own: Iterable[str] = ()) -> DataFrame:
    """Awards of the files that decisions were made on (won, lost, presented), others' only."""
    d = decisions.where(F.col("estado").isin("ganada", "perdida", "presentada")).select("licitacion_id", "estado")
    others = awards.where((F.col("cif_adjudicatario") != "") & ~F.col("cif_adjudicatario").isin(list(own))) if list(own) else awards.where("cif_adjudicatario <> ''")
    return others.join(maybe_broadcast(d), "licitacion_id")


def rivals(decisions: DataFrame, awards: DataFrame, own: Iterable[str] = ()) -> DataFrame:
    """Per winner other than one's own, most lost to first: files met in, files lost to it, amount, last name. One pre-aggregate per winner
    and file, so nothing is counted distinct."""
    named = F.struct(F.col("adjudicatario").isNotNull() & (F.trim("adjudicatario") != ""), F.coalesce("fecha_adjudicacion", F.lit("1900-01-01").cast("date")), "licitacion_id", "lote", "adjudicatario")
    per_file = met(decisions, awards, own).groupBy("cif_adjudicatario", "licitacion_id").agg(F.max((F.col("estado") == "perdida").cast("int")).alias("perdido"), F.sum("importe_sin_iva").alias("importe"), F.max(named).alias("n"))
    out = per_file.groupBy("cif_adjudicatario").agg(F.count(F.lit(1)).alias("expedientes"), F.sum("perdido").cast("long").alias("perdidos"), F.sum("importe").cast("decimal(30,2)").alias("importe"), F.max("n").getField("adjudicatario").alias("nombre"))
    return out.orderBy(F.desc("perdidos"), F.desc("expedientes"), F.desc_nulls_last("importe"), "cif_adjudicatario")


def head_to_head(decisions: DataFrame, awards: DataFrame, catalogue: DataFrame, rival: str | None = None) -> DataFrame:
    """The awards met, with the notice's title where the catalogue has it, newest first; of one rival if given."""
    m = met(decisions, awards)
    m = m.where(F.col("cif_adjudicatario") == rival) if rival else m
    return m.join(catalogue.select("licitacion_id", "titulo"), "licitacion_id", "left").orderBy(F.desc_nulls_last("fecha_adjudicacion"), "licitacion_id", "lote", "cif_adjudicatario")


def toggled(selected: list[str], one: str, most: int = 3) -> list[str]:
    """The comparator's selection after a click: known ones go, new ones come while there is room."""
    if one in selected:
        return [s for s in selected if s != one]
    return [*selected, one] if len(selected) < most else selected


def comparison(selected: list[str], competitors: DataFrame, rival_rows: DataFrame) -> DataFrame:
    """A row for each of two or three identifiers, in their order: stored figures and those of the meetings; 0 or null where there are none."""
    if not 2 <= len(set(selected)) <= 3 or len(set(selected)) != len(selected):
        raise ValueError("two or three different identifiers")
    wanted = competitors.sparkSession.createDataFrame([(i, s) for i, s in enumerate(selected)], "orden int, cif string")
    best = competitors.where(F.col("cif").isin(selected)).groupBy("cif").agg(F.max_by(F.struct("nombre_canonico", "n_lotes", "importe_total_sin_iva"), F.struct("updated_at", -F.col("ficha_id"))).alias("c"))
    seen = rival_rows.where(F.col("cif_adjudicatario").isin(selected)).select(F.col("cif_adjudicatario").alias("cif"), "expedientes", "perdidos")
    j = F.broadcast(wanted).join(best, "cif", "left").join(seen, "cif", "left").orderBy("orden")  # three rows
    return j.select("orden", "cif", F.col("c.nombre_canonico").alias("nombre"), F.coalesce("c.n_lotes", F.lit(0)).alias("n_lotes"), F.col("c.importe_total_sin_iva").alias("importe"), F.coalesce("expedientes", F.lit(0)).alias("expedientes"), F.coalesce("perdidos", F.lit(0)).alias("perdidos"))


def tabs(cards: DataFrame) -> DataFrame:
    """Adds the tabs a card (estado, favorita, viva, radar) belongs to: 'favoritas', its state's own, 'activas' and 'caducadas' for those
    without a state. Cards from the catalogue (radar false) are in the first two only."""
    own = F.when(F.col("estado").isin("ganada", "perdida", "presentada", "descartada"), F.concat("estado", F.lit("s")))
    free = F.when(F.col("estado").isNull() & F.col("radar"), F.when(F.col("viva"), "activas").otherwise("caducadas"))
    return cards.withColumn("pestanas", F.filter(F.array(F.when(F.col("favorita"), "favoritas"), own, free), lambda x: x.isNotNull()))


def badge(state: str, n: str) -> Column:
    """What a result's badge says."""
    lots = F.concat(F.col(n), F.when(F.col(n) == 1, " lote desierto").otherwise(" lotes desiertos"))
    return F.when(F.col(state) == "desierta_total", "Desierta").when(F.col(state) == "desierta_parcial", lots).when(F.col(state) == "retirada", "Retirada")


