"""Jobs that compose the operators into layers, the state store, and the query catalog."""
