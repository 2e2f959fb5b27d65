"""Feature preparation and clustering of wide tables on Spark."""

from clusterprep.plans.cluster_job import ClusterParams, ClusterResult, cluster_table, run
from clusterprep.plans.prepare import PreparedData, prepare_training_data
from clusterprep.plans.sample_file import write_sample

__all__ = [
    "ClusterParams",
    "ClusterResult",
    "PreparedData",
    "cluster_table",
    "prepare_training_data",
    "run",
    "write_sample",
]
