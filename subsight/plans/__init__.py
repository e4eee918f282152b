"""Plans above single queries: the session, the query registry, the
silver -> gold pipeline and table metadata."""
