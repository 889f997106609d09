"""docloom: document catalogs and field extraction as Spark jobs.

Every operator takes DataFrames and returns DataFrames (or a small result
object that holds several).  Nothing here starts a session, keeps hidden state
or pulls rows to the driver; the few functions that do run a job while
planning (loops over tree depth, strict checks) say so in their docstring.
"""

__version__ = "0.1.0"
