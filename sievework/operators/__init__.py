"""DataFrame operators; see the modules for one topic each."""
