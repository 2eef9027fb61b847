"""All driver queries of the library proper and their SQL."""

from feedloom.plans import contract_oracle, contract_queries, oracle, queries, recommend_oracle, recommend_queries

QUERIES = {**queries.QUERIES, **contract_queries.QUERIES, **recommend_queries.QUERIES}
ORACLE = {**oracle.ORACLE, **contract_oracle.ORACLE, **recommend_oracle.ORACLE}
