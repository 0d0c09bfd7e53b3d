"""terrasieve: land-boundary, raster and corpus analytics written as Spark jobs."""
