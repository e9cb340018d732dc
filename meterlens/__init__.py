"""Usage, cost and health reports over cloud-warehouse usage logs, as Spark jobs."""
