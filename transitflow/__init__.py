"""transitflow: public-transport analytics as native Spark DataFrame jobs.

Batch jobs clean bus-network schedule tables (fares, routes, shapes, stops,
trips, stop times), measure route shapes segment by segment with great-circle
geometry, and place every stop of a representative trip along its route by a
spatially keyed corridor join.  A Structured Streaming job normalises a vehicle
GPS feed with the same transform as its batch form.
"""

__version__ = "0.1.0"
