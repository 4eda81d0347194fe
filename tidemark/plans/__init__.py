"""Plans: the driver tables as series (surrogates) and every operator as a query."""
