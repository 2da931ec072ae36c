from tallywood.stats.correlation import average_ranks, pearson, pearson_vectors, spearman
from tallywood.stats.independence import chi_square, chi_square_p_values
from tallywood.stats.summary import baseline_accuracy, vector_summary

__all__ = [
    "average_ranks",
    "baseline_accuracy",
    "chi_square",
    "chi_square_p_values",
    "pearson",
    "pearson_vectors",
    "spearman",
    "vector_summary",
]
