"""Q1: the topic report, one lazy plan per part.

``topic_report`` runs the search once; matched payments, the edge list and
the degree table are persisted and shared by every branch (summary, top
users, degree bars, components, community bars and subgraph, examples).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import components as C
from ..operators import search as S
from ..operators import topic_graph as G
from ..schemas import PAYMENT_COLUMNS


@dataclass
class TopicGraph:
    """The undirected topic graph of a set of payments."""
    payments: DataFrame
    nodes: DataFrame
    edges: DataFrame

    @classmethod
    def from_payments(cls, payments: DataFrame) -> "TopicGraph":
        return cls(payments, G.build_nodes(payments), G.build_edges(payments))

    def degrees(self) -> DataFrame:
        return G.degrees(self.edges)

    def summary(self) -> DataFrame:
        return G.graph_summary(self.nodes, self.edges)

    def components(self) -> DataFrame:
        return C.connected_components(self.nodes, self.edges)

    def persist(self) -> "TopicGraph":
        lvl = StorageLevel.MEMORY_AND_DISK
        return TopicGraph(self.payments.persist(lvl), self.nodes.persist(lvl), self.edges.persist(lvl))


@dataclass
class TopicReport:
    summary: DataFrame
    top_users: DataFrame
    degree_bars: DataFrame
    component_bars: DataFrame
    top_communities: DataFrame
    community_nodes: DataFrame
    community_edges: DataFrame
    examples: DataFrame
    shared: tuple = ()

    def release(self) -> None:
        """Unpersist the frames the parts share (call when done)."""
        for df in self.shared:
            df.unpersist()


def topic_graph(payments: DataFrame, topic: str, t0, t1, mode: str = "match",
                synonyms: bool = False, tokens: str | None = None) -> TopicGraph:
    matched = S.match_topic(payments, topic, t0, t1, mode=mode, synonyms=synonyms,
                            tokens=tokens).select(*PAYMENT_COLUMNS)
    return TopicGraph.from_payments(matched)


def topic_report(payments: DataFrame, topic: str, t0, t1, mode: str = "match",
                 synonyms: bool = False, tokens: str | None = None, k: int = 10) -> TopicReport:
    g = topic_graph(payments, topic, t0, t1, mode, synonyms, tokens).persist()
    deg = g.degrees().persist(StorageLevel.MEMORY_AND_DISK)
    comp = g.components().persist(StorageLevel.MEMORY_AND_DISK)
    sizes = C.component_sizes(comp)
    top = C.top_communities(sizes, k)
    cnodes = C.community_nodes(comp, top, deg, g.nodes)
    info = F.struct(F.lit(topic).alias("words"), F.lit(str(t0)).alias("time_from"),
                    F.lit(str(t1)).alias("time_end"))
    return TopicReport(
        summary=g.summary().select(info.alias("query"), "*"),
        top_users=G.top_users(deg, g.nodes, k),
        degree_bars=G.degree_histogram(deg),
        component_bars=C.component_histogram(sizes),
        top_communities=top,
        community_nodes=cnodes,
        community_edges=C.community_edges(g.edges, cnodes),
        examples=S.sample_messages(g.payments),
        shared=(g.payments, g.nodes, g.edges, deg, comp),
    )
