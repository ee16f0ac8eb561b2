from quillmesh.plans.pipelines import main

main()
