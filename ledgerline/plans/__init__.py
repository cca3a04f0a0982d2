"""Planning choices made explicit: the query registry, its SQL oracle and input materialisation."""
