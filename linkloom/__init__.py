"""Link-graph analytics over tables of fetched pages."""
