"""DataFrame -> DataFrame operators: cleaning, scaling, conforming, star
schema, quality rules and stage audit."""
