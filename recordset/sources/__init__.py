"""Sources: record sets on files, schema inference for schemaless bins, delimited ingest, chained reader/writer."""
