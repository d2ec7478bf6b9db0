"""Labels of official codes. Raw codes are what is stored; a label is looked up when shown, and an unknown code has none."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How a lot's procedure ended.
RESULTS = {
    "1": "Adjudicado provisionalmente", "2": "Adjudicado definitivamente", "3": "Desierto", "4": "Desistimiento", "5": "Renuncia", "6": "Desierto provisionalmente",
    "7": "Desierto definitivamente", "8": "Adjudicado", "9": "Formalizado", "10": "Licitador mejor valorado", "11": "Encargo formalizado",
}
#: Contracting systems.
SYSTEMS = {"0": "Contrato normal", "1": "Acuerdo Marco (establecimiento)", "2": "Sistema Dinámico (establecimiento)", "3": "Contrato basado en Acuerdo Marco", "4": "Contrato basado en Sistema Dinámico"}
#: Contract types.
TYPES = {"1": "Suministros", "2": "Servicios", "3": "Obras", "8": "Privado", "21": "Gestión de Servicios Públicos", "22": "Concesión de Servicios", "31": "Concesión de Obras Públicas", "50": "Patrimonial"}


def label(codes: dict[str, str], column: str) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in codes.items() for x in kv]), column)
