"""Jobs over whole tables: harvest, archive recovery, corpus build, graph, second source, samples, reports."""
