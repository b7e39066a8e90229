"""End-to-end jobs (``crawl_job``), the registered queries with their SQL oracles
(``catalog``) and the command line (``cli``)."""
