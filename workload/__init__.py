"""Driver-table workload: fixtures, registered queries and their SQL oracles."""
