"""topicgraph: topic-driven social-network analytics on Spark DataFrames.

Entry points::

    from topicgraph import get_spark, ingest, read_index, topic_report
    from topicgraph import MultiGraph, FilterChain, hits, shortest_paths
"""

from .operators.centrality import hits
from .operators.components import connected_components
from .operators.filters import FilterChain
from .operators.multigraph import MultiGraph
from .operators.paths import shortest_path, shortest_paths
from .operators.search import explained_search, match_topic
from .plans.report import TopicGraph, TopicReport, topic_graph, topic_report
from .session import get_spark
from .sources.ingest import ingest, parse_payments, read_index, read_lines, write_payments

__all__ = [
    "FilterChain", "MultiGraph", "TopicGraph", "TopicReport", "connected_components",
    "explained_search", "get_spark", "hits", "ingest", "match_topic", "parse_payments",
    "read_index", "read_lines", "shortest_path", "shortest_paths", "topic_graph", "topic_report",
    "write_payments",
]
