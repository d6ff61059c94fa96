"""DataFrame operators: dataset building, retrieval, evaluation, gold sets and observability."""
