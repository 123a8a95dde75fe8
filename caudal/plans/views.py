"""The masked projection analysts see instead of the customer dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.functions.rules import score_band


def analyst_view(dim_customers: DataFrame) -> DataFrame:
    """Shortened hashes, a score band instead of the score, and no city."""
    return dim_customers.select(
        "id_cli",
        F.concat(F.left("nombre_hash", F.lit(4)), F.lit("****")).alias("nombre_ofuscado"),
        F.concat(F.lit("***"), F.right("num_doc_hash", F.lit(4))).alias("doc_ofuscado"),
        "tip_doc", "edad", "fec_alta", "cod_segmento", "segmento_label",
        score_band("score_buro").alias("rango_score_buro"),
        "depto_res", "estado_cli", "ind_activo", "canal_adquis",
    )


def create_analyst_view(dim_customers: DataFrame, name: str = "vw_dim_clientes_analista") -> None:
    """Register the masked projection under a name, for SQL users of this session."""
    analyst_view(dim_customers).createOrReplaceTempView(name)
