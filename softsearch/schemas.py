"""Row types of the tables that pass between the steps."""

from pyspark.sql import types as T

_S, _L, _I = T.StringType(), T.LongType(), T.IntegerType()
_D, _B = T.DoubleType(), T.BooleanType()
_VEC, _DVEC = T.ArrayType(T.FloatType()), T.ArrayType(T.DoubleType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


CORPUS = _struct(doc_id=_S, src_id=_L, text=_S, label=_I)
VECTOR_TABLE = _struct(
    doc_id=_S, document=_S, embedding=_VEC, label=_I, category=_S,
    dominant_cluster=_I, is_boundary=_B, mem_top1=_D, mem_top2=_D,
)
CENTROIDS = _struct(cluster=_I, centroid=_DVEC)
MODEL_PARAMS = _struct(n_clusters=_I, m=_D, iterations=_I, objective=_D, converged=_B)
FIT_HISTORY = _struct(iteration=_I, objective=_D, delta=_D)
#: a query as the cache sees it: ``seq`` is the clock of its cache
QUERY_LOG = _struct(cache_id=_S, seq=_L, query=_S, embedding=_VEC)
#: what the cache decided for one query
DECISIONS = _struct(
    cache_id=_S, seq=_L, cache_hit=_B, matched_seq=_L, similarity=_D,
)
ANSWERS = _struct(
    query=_S, cache_hit=_B, matched_query=_S, similarity_score=_D, result=_S, dominant_cluster=_I,
)
CACHE_STATS = _struct(total_entries=_L, hit_count=_L, miss_count=_L, hit_rate=_D)
FLUSH_REPORT = _struct(message=_S, entries_cleared=_L)
K_SWEEP = _struct(k=_I, silhouette=_D, davies_bouldin=_D)
